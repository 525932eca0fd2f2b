"""Figure captions, crop geometry, placement and reconciliation. Geometry is in points, origin at a page's top left.

Null texts hold no caption; null coordinates give null rectangles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Caption styles: (pattern, number of groups). Fixed patterns. The two-part style backs off by a digit before a third part;
#: ``two-part-strict`` does not match a three-part caption at all.
STYLES = {
    "two-part": (r"(?i)Figure\s+(\d+)\.(\d+)(?!\.\d)", 2),
    "two-part-strict": (r"(?i)Figure\s+(\d+)\.(\d+)(?![\d]|\.\d)", 2),
    "three-part": (r"Figure\s+(\d+)\.(\d+)\.(\d+)", 3),
    "roman": (r"(?i)Figure\s+(I{1,3}V?)\s*[-–—]\s*(\d+[a-z]?)", 2),
}
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}


def captions(df: DataFrame, text: str, style: str) -> DataFrame:
    """``df`` exploded by its captions of a style: ord, chapter, fig_id. An unknown roman number is chapter 0."""
    pattern, n = STYLES[style]
    groups = [F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i + 1)).alias(f"g{i}") for i in range(n)]
    out = df.select("*", F.posexplode(F.arrays_zip(*groups)).alias("ord", "__g"))
    parts = [F.col("__g")[f"g{i}"] for i in range(n)]
    if style == "roman":
        number = F.upper(parts[0])
        known = F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])
        return out.select("*", F.coalesce(F.try_element_at(known, number), F.lit(0)).alias("chapter"), F.concat(number, F.lit("-"), parts[1]).alias("fig_id")).drop("__g")
    return out.select("*", parts[0].try_cast("int").alias("chapter"), F.concat_ws(".", *parts).alias("fig_id")).drop("__g")


def first_caption(text: Column, style: str) -> Column:
    """Id of the first caption in a block's text; null if there is none."""
    pattern, n = STYLES[style]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = [F.regexp_extract(F.try_element_at(found, F.lit(1)), pattern.replace(r"(?!\.\d)", "").replace(r"(?![\d]|\.\d)", ""), i + 1) for i in range(n)]
    ident = F.concat(F.upper(parts[0]), F.lit("-"), parts[1]) if style == "roman" else F.concat_ws(".", *parts)
    return F.when(F.size(found) > 0, ident)


def captions_in_boxes(boxes: DataFrame, style: str, dpi: float = 150.0) -> DataFrame:
    """Captions in recognised boxes (text, bbox of four corners): ``boxes`` with fig_id and the caption's top in points."""
    out = boxes.withColumn("fig_id", first_caption(F.col("text"), style)).where("fig_id is not null")
    return out.withColumn("caption_y", F.col("bbox")[0][1] / F.lit(dpi / 72))


def image_path(chapter: Column, fig_id: Column) -> Column:
    """``figures/chNN/fig_<id>.png`` with ``.`` and ``-`` of the id as ``_``."""
    return F.concat(F.lit("figures/ch"), F.lpad(chapter.cast("string"), 2, "0"), F.lit("/fig_"), F.translate(fig_id, ".-", "__"), F.lit(".png"))


def first_of_each(figs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per figure: the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return figs.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def per_chapter(figs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Number of figures, first and last id per group, with partial aggregates only."""
    o = F.struct(*order)
    return figs.groupBy(*keys).agg(F.count("*").alias("figures"), F.min_by("fig_id", o).alias("first_id"), F.max_by("fig_id", o).alias("last_id"))


def _rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in zip((x0, y0, x1, y1), ("x0", "y0", "x1", "y1"))])


def body_bottom(blocks: Column, caption_y: Column, gap: float, skip_captions: bool) -> Column:
    """Bottom edge of the lowest text block of more than 50 characters that ends above the caption."""

    def fits(b: Column) -> Column:
        t = F.regexp_replace(b["text"], r"^\s+|\s+$", "")
        ok = (F.length(t) > 50) & (b["y1"] < caption_y - gap)
        return ok & ~t.startswith("Figure") if skip_captions else ok

    return F.array_max(F.transform(F.filter(blocks, fits), lambda b: b["y1"]))


def crop_by_text(blocks: Column, caption_y: Column, width: Column, height: Column) -> Column:
    """From below the lowest body text (else 30) to 40 below the caption's top, at most 350 above it, inside the page."""
    top = F.coalesce(body_bottom(blocks, caption_y, 10, True) + 5, F.lit(30.0))
    return _rect(F.lit(30), F.greatest(top, caption_y - 350, F.lit(20.0)), width - 30, F.least(caption_y + 40, height - 10))


def crop_by_ocr(top_px: Column, width: Column, dpi: float = 150.0) -> Column:
    """From 280 above to 25 below a caption found in an image of ``dpi``."""
    y = top_px / F.lit(dpi / 72)
    return _rect(F.lit(25), F.greatest(F.lit(30.0), y - 280), width - 25, y + 25)


def crop_by_nearest(blocks: Column, caption_y: Column, caption_bottom: Column, width: Column) -> Column:
    """From below the nearest body text, else 300 above; at least 50 high, else 200 above."""
    above = F.exists(blocks, lambda b: b["y1"] < caption_y - 5)
    top = F.when(above, F.coalesce(body_bottom(blocks, caption_y, 5, False) + 5, F.greatest(F.lit(30.0), caption_y - 300))).otherwise(F.lit(30.0))
    top = F.when(caption_y - top < 50, F.greatest(F.lit(30.0), caption_y - 200)).otherwise(top)
    return _rect(F.lit(30), top, width - 30, caption_bottom + 10)


def crop_above(y0: Column, y1: Column, width: Column) -> Column:
    """From 200 above a caption block to 4 below it, full width."""
    return _rect(F.lit(0), F.greatest(F.lit(0.0), y0 - 200), width, y1 + 4)


def nearest_above(captions_: DataFrame, blocks: DataFrame, keys: list[str], caption_y: str, bottom: str, gap: float) -> DataFrame:
    """As-of lookup: for each caption the lowest block bottom at least ``gap`` above it on its page, as one ordered window
    over both, so no caption meets every block."""
    c = captions_.select(*captions_.columns, (F.col(caption_y) - gap).alias("__y"), F.lit(None).cast("double").alias("__b"), F.lit(0).alias("__k"))
    b = blocks.where(F.col(bottom).isNotNull()).select(*[F.col(k) if k in keys else F.lit(None).cast(t).alias(k) for k, t in captions_.dtypes], F.col(bottom).cast("double").alias("__y"), F.col(bottom).cast("double").alias("__b"), F.lit(1).alias("__k"))
    w = Window.partitionBy(*keys).orderBy("__y", "__k").rowsBetween(Window.unboundedPreceding, -1)
    both = c.unionByName(b).withColumn("nearest_bottom", F.last("__b", ignorenulls=True).over(w))
    return both.where("__k = 0").select(*captions_.columns, "nearest_bottom")


def located(wanted: DataFrame, spans: DataFrame, keys: list[str], text: str, retry: str) -> DataFrame:
    """First span of each searched text on its page, with a second spelling where the first is nowhere."""
    first = spans.groupBy(*keys, "span_text").agg(F.min_by(F.struct("x0", "y0", "x1", "y1"), "ord").alias("rect"))
    one = first.select(*keys, F.col("span_text").alias(text), F.col("rect").alias("__r1"))
    two = first.select(*keys, F.col("span_text").alias(retry), F.col("rect").alias("__r2"))
    return wanted.join(one, [*keys, text], "left").join(two, [*keys, retry], "left").withColumn("rect", F.coalesce("__r1", "__r2")).drop("__r1", "__r2")


FIGURE_LABEL = r"\\label\{[^}]*?(\d+(?:[._]\d+){1,2})\}"
FIGURE_ENV = r"(?s)\\begin\{figure\}.*?\\end\{figure\}"


def rewritten_paths(files: DataFrame, figs: DataFrame, keys: list[str], text: str = "content", row: str = "file_id") -> DataFrame:
    """Figure environments with the image path of the figure that their label names, by place: each environment is rebuilt
    on its own, so two figures with one placeholder cannot be confused. ``figs``: (keys, fig_id, path); of several paths
    of one figure the least counts. ``row`` names a file; each gets the paths of its own figures only."""
    env_ids = F.transform(F.regexp_extract_all(F.col(text), F.lit(FIGURE_ENV), F.lit(0)), lambda env: F.regexp_replace(F.regexp_extract(env, FIGURE_LABEL, 1), "_", "."))
    asked = files.select(row, *keys, F.explode(F.array_distinct(env_ids)).alias("fig_id")).where("fig_id <> ''")
    found = asked.join(figs.groupBy(*keys, "fig_id").agg(F.min("path").alias("path")), [*keys, "fig_id"])
    paths = found.groupBy(row).agg(F.map_from_entries(F.collect_set(F.struct("fig_id", "path"))).alias("__paths"))
    outside, inside = F.split(text, FIGURE_ENV, -1), F.regexp_extract_all(F.col(text), F.lit(FIGURE_ENV), F.lit(0))

    def rebuilt(env: Column) -> Column:
        # the id in the label, its parts joined by any sign
        fig = F.regexp_replace(F.regexp_extract(env, FIGURE_LABEL, 1), "_", ".")
        path = F.try_element_at(F.col("__paths"), fig)
        pieces = F.split(env, r"\\includegraphics(?:\[[^\]]*\])?\{[^}]*\}", 2)
        new = F.concat(F.element_at(pieces, 1), F.lit("\\includegraphics[width=0.8\\textwidth]{"), path, F.lit("}"), F.try_element_at(pieces, F.lit(2)))
        return F.coalesce(new, env)

    body = F.array_join(F.transform(F.arrays_zip(outside.alias("o"), F.transform(inside, rebuilt).alias("i")), lambda p: F.concat(p["o"], F.coalesce(p["i"], F.lit("")))), "")
    out = files.join(paths, row, "left")
    return out.withColumn("__new", F.when(F.col("__paths").isNull(), F.col(text)).otherwise(body)).withColumn("changed", F.coalesce(F.col("__new") != F.col(text), F.lit(False))).withColumn(text, F.col("__new")).drop("__new", "__paths")


def reconciled(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Figures present on one side only or on both, by a full outer join of distinct keys."""
    a = left.select(*keys).distinct().withColumn("__l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("__r", F.lit(True))
    side = F.when(F.col("__r").isNull(), "only_left").when(F.col("__l").isNull(), "only_right").otherwise("both")
    return a.join(b, keys, "full").select(*keys, side.alias("side"))
