"""Problem 8: sources mixed to target shares of the tokens, with capped repeats.

Tokens are summed per source (partial sums before the shuffle, so a source that holds a third of the rows costs no
more than another). A mix has a target size T in tokens: by default all tokens of its listed sources, else a number given,
or ``EXACT``: the largest at which no source needs more than its cap (the least of ``cap * tokens / share``), at which
every share is met but a small source with a large share makes the whole mix small. A source's rate is
``share * T / tokens``, at most its cap; what a capped source falls short of is reported, and no other source fills it. Each
document is emitted floor(rate) times plus one Bernoulli copy with probability rate - floor(rate), seeded by a hash of mix
and doc_id: a rerun or another partitioning gives the same mix.

Defined cases
-------------
* listed source without tokens: rate and actual share null and 0; the other shares are scaled to sum to 1.
* source listed twice in a mix: shares add up, the smaller cap counts. Null share, share <= 0 or null cap or cap < 1:
  the source gets nothing. Null mix name or source: the row is ignored, as are documents of null or unlisted source.
* documents of no tokens (null, empty) are never chosen: they cannot change a share.
* repeated doc_id rows are documents of their own with the same seed. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.cluster import cut
from quire.llm.tokens import VOCAB_DIR, token_counts

SEED = 20240611
EXACT = "exact"


def counted(docs: DataFrame, vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """(doc_id, source, n_tokens), encoded once and kept in the shared folder."""
    return cut(token_counts(docs.where(F.col("source").isNotNull()), ["doc_id", "source"], vocab_dir=vocab_dir))


def rates(sizes: DataFrame, targets: DataFrame, size: int | str | None = None) -> DataFrame:
    """(mix_name, source, target_share, max_repeats, source_tokens, target_tokens, rate). ``size``: tokens of every mix,
    ``EXACT``, or None for all tokens listed."""
    per_source = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count_if(F.col("n_tokens") > 0).alias("source_docs"))
    want = (
        targets.where(F.col("mix_name").isNotNull() & F.col("source").isNotNull())
        .groupBy("mix_name", "source")
        .agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    )
    both = want.join(per_source, "source", "left")
    usable = (F.col("source_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") >= 1)
    w = Window.partitionBy("mix_name")
    both = both.withColumn("__share", F.when(usable, F.col("target_share")))
    both = both.withColumn("__share", F.col("__share") / F.sum("__share").over(w))
    if size == EXACT:
        total = F.min(F.col("max_repeats") * F.col("source_tokens") / F.col("__share")).over(w)
    elif size is None:
        total = F.sum(F.when(F.col("__share").isNotNull(), F.col("source_tokens"))).over(w).cast("double")
    else:
        total = F.lit(float(size))
    both = both.withColumn("target_tokens", F.col("__share") * total)
    both = both.withColumn("rate", F.least(F.col("target_tokens") / F.col("source_tokens"), F.when(F.col("__share").isNotNull(), F.col("max_repeats").cast("double"))))
    both = both.withColumn("rate", F.when(F.col("__share").isNotNull(), F.col("rate")))
    return both.select("mix_name", "source", "target_share", "max_repeats", F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"), "target_tokens", "rate")


def chosen(sizes: DataFrame, rate: DataFrame, seed: int = SEED) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, repeats) of the documents in each mix."""
    x = sizes.where("n_tokens > 0").join(rate.where("rate > 0").select("mix_name", "source", "rate"), "source")
    unit = (F.xxhash64("mix_name", "doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    # a rate that is a whole number up to rounding has no fraction
    rate_ = F.round("rate", 9)
    copies = (F.floor(rate_) + (unit < rate_ - F.floor(rate_)).cast("bigint")).cast("int")
    return x.select("mix_name", "source", "doc_id", "n_tokens", copies.alias("repeats")).where("repeats > 0")


def shares(picked: DataFrame, rate: DataFrame) -> DataFrame:
    """Actual against target share of each source of each mix, and the tokens (expected, 0 or more) by which its cap keeps it
    short of its target."""
    got = picked.groupBy("mix_name", "source").agg(
        F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("mix_tokens")
    )
    out = rate.join(got, ["mix_name", "source"], "left").fillna(0, ["documents", "most_repeats", "mix_tokens"])
    total = F.sum("mix_tokens").over(Window.partitionBy("mix_name"))
    short = F.greatest(F.lit(0.0), F.col("target_tokens") - F.col("rate") * F.col("source_tokens"))
    out = out.withColumn("shortfall_tokens", F.coalesce(F.round(short, 3), F.lit(0.0)))
    return out.withColumn("actual_share", F.when(total > 0, F.col("mix_tokens") / total).otherwise(0.0))
