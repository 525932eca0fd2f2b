"""A packrat parsing-expression engine and grammars of Python 3, JSON, key=value files and LaTeX.

A grammar is text in the usual notation: ``rule <- e1 / e2``, sequence by blanks, ``? * +`` after and ``& !`` before an
expression, parentheses, ``'literal'`` and ``~name~`` for a named terminal. Rules are memoized by position for one
parse (packrat), so a parse takes time linear in the input; the furthest position at which a terminal failed and what
was expected there are kept. A text is valid only if the start rule consumes all of it.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

Step = Callable[[int], int]  # position -> position after the match, or -1


class Packrat:
    """A grammar compiled to closures. ``terminal(name)`` gives a function of (input, position) -> end or -1."""

    def __init__(self, grammar: str, start: str, terminal: Callable[["Packrat", str, bool], Step]) -> None:
        self.data: object = None
        self.far = 0
        self.want = ""
        self._memos: list[dict[int, int]] = []
        self._rules: dict[str, Step] = {}
        self._terminal = terminal
        bodies = {}
        for part in re.split(r"\n(?=\w+\s*<-)", grammar.strip()):
            name, _, body = part.partition("<-")
            bodies[name.strip()] = body
        for name in bodies:
            self._rules[name] = self._memoized(name)
        self._bodies = {name: self._compile(body) for name, body in bodies.items()}
        self._start = self._rules[start]

    def _memoized(self, name: str) -> Step:
        memo: dict[int, int] = {}
        self._memos.append(memo)

        def run(p: int) -> int:
            r = memo.get(p)
            if r is None:
                r = memo[p] = self._bodies[name](p)
            return r

        return run

    def parse(self, data: object, at: int = 0) -> int:
        """End of the match of the start rule, -1 if there is none; ``far`` and ``want`` tell of the furthest failure."""
        self.data, self.far, self.want = data, at - 1, ""
        for m in self._memos:
            m.clear()
        return self._start(at)

    # --- compiling ---
    def _compile(self, body: str) -> Step:
        toks = re.findall(r"'(?:[^'\\]|\\.)*'|~\w+~|\w+|[/?*+&!()]", body)
        at = 0

        def choice() -> Step:
            nonlocal at
            options = [sequence()]
            while at < len(toks) and toks[at] == "/":
                at += 1
                options.append(sequence())
            return options[0] if len(options) == 1 else _choice(options)

        def sequence() -> Step:
            parts = []
            while at < len(toks) and toks[at] not in ("/", ")"):
                parts.append(prefixed())
            return parts[0] if len(parts) == 1 else _sequence(parts)

        def prefixed() -> Step:
            nonlocal at
            if toks[at] in ("&", "!"):
                sign = toks[at]
                at += 1
                return _ahead(prefixed(), sign == "&")
            e = atom()
            while at < len(toks) and toks[at] in ("?", "*", "+"):
                e = {"?": _optional, "*": _star, "+": _plus}[toks[at]](e)
                at += 1
            return e

        def atom() -> Step:
            nonlocal at
            t = toks[at]
            at += 1
            if t == "(":
                e = choice()
                at += 1
                return e
            if t[0] == "'":
                return self._terminal(self, t[1:-1].replace("\\'", "'"), True)
            if t[0] == "~":
                return self._terminal(self, t[1:-1], False)
            return self._rules[t]

        return choice()


def _choice(options: list[Step]) -> Step:
    options = tuple(options)

    def run(p: int) -> int:
        for e in options:
            r = e(p)
            if r >= 0:
                return r
        return -1

    return run


def _sequence(parts: list[Step]) -> Step:
    parts = tuple(parts)

    def run(p: int) -> int:
        for e in parts:
            p = e(p)
            if p < 0:
                return -1
        return p

    return run


def _ahead(e: Step, wanted: bool) -> Step:
    return lambda p: p if (e(p) >= 0) is wanted else -1


def _optional(e: Step) -> Step:
    def run(p: int) -> int:
        r = e(p)
        return p if r < 0 else r

    return run


def _star(e: Step) -> Step:
    def run(p: int) -> int:
        while True:
            r = e(p)
            if r < 0 or r == p:
                return p
            p = r

    return run


def _plus(e: Step) -> Step:
    again = _star(e)

    def run(p: int) -> int:
        r = e(p)
        return -1 if r < 0 else again(r)

    return run


# --- terminals over characters ---
def over_text(patterns: dict[str, str]) -> Callable[[Packrat, str, bool], Step]:
    def terminal(g: Packrat, name: str, literal: bool) -> Step:
        match = re.compile(re.escape(name) if literal else patterns[name], re.S).match

        def run(p: int) -> int:
            m = match(g.data, p)
            if m:
                return m.end()
            if p > g.far:
                g.far, g.want = p, name
            return -1

        return run

    return terminal


# --- JSON ---
JSON = Packrat(
    """
file <- ~ws~ value ~ws~ ~end~
value <- object / array / ~string~ / ~number~ / ~word~
object <- ~open~ (pair (~comma~ pair)*)? ~close~
pair <- ~string~ ~colon~ value
array <- ~lbrack~ (value (~comma~ value)*)? ~rbrack~
""",
    "file",
    over_text({
        "ws": r"[ \t\r\n]*", "end": r"\Z", "string": r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"',
        "number": r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?", "word": r"true|false|null",
        "open": r"\{[ \t\r\n]*", "close": r"[ \t\r\n]*\}", "lbrack": r"\[[ \t\r\n]*", "rbrack": r"[ \t\r\n]*\]",
        "comma": r"[ \t\r\n]*,[ \t\r\n]*", "colon": r"[ \t\r\n]*:[ \t\r\n]*",
    }),
)

# --- KEY=value lines ---
CONF = Packrat(
    """
file <- (line ~eol~)* line ~end~
line <- ~comment~ / pair / ~blank~
pair <- ~key~ '=' (~double~ / ~single~ / ~bare~) ~blank~
""",
    "file",
    over_text({
        "eol": r"\r?\n", "end": r"\Z", "blank": r"[ \t\r]*(?=\n|\Z)", "comment": r"[ \t]*#[^\n]*", "key": r"[ \t]*[A-Za-z_][A-Za-z0-9_.-]*",
        "double": r'"[^"\n]*"', "single": r"'[^'\n]*'", "bare": r"""[^\s"']*(?=[ \t\r]*(?:\n|\Z))""",
    }),
)


# --- LaTeX: what must pair and nest ---
class _Latex(Packrat):
    """``~begin~`` remembers its environment's name by position for ``env``, which only accepts the end of that name."""

    def _compile(self, body: str) -> Step:
        if body.strip() != "@environment":
            return super()._compile(body)
        begin, end = re.compile(r"\\begin\s*\{([^{}\n]*)\}").match, re.compile(r"\\end\s*\{([^{}\n]*)\}").match
        inner = _star(self._rules["item"])

        def run(p: int) -> int:
            m = begin(self.data, p)
            if not m:
                return -1
            q = inner(m.end())
            e = end(self.data, q)
            if e and e.group(1) == m.group(1):
                return e.end()
            if q >= self.far:
                self.far, self.want = q, f"end of {m.group(1)}"
            return -1

        return run


LATEX = _Latex(
    """
file <- (item)* ~end~
item <- ~text~ / ~comment~ / ~verbatim~ / ~verb~ / environment / ~escaped~ / ~command~ / group / display / inline / brackets / parens
group <- ~lbrace~ item* ~rbrace~
display <- ~dollars~ initem* ~dollars~
inline <- !~dollars~ ~dollar~ initem* ~dollar~
initem <- ~text~ / ~comment~ / ~verb~ / environment / ~escaped~ / ~command~ / group
brackets <- ~lsquare~ item* ~rsquare~
parens <- ~lparen~ item* ~rparen~
environment <- @environment
""",
    "file",
    over_text({
        "end": r"\Z", "text": r"[^\\{}$%]+", "comment": r"%[^\n]*", "verb": r"\\verb\*?([^A-Za-z\s*])(?:(?!\1)[^\n])*\1",
        "verbatim": r"\\begin\{(verbatim\*?|Verbatim|lstlisting|minted|comment)\}.*?\\end\{\1\}",
        "escaped": r"\\[^A-Za-z\[\]()]", "command": r"\\(?!(?:begin|end|verb)(?![A-Za-z]))[A-Za-z@]+\*?",
        "lbrace": r"\{", "rbrace": r"\}", "dollars": r"\$\$", "dollar": r"\$", "lsquare": r"\\\[", "rsquare": r"\\\]", "lparen": r"\\\(", "rparen": r"\\\)",
    }),
)

# --- Python 3, over tokens ---
KEYWORDS = frozenset(
    "False None True and as assert async await break class continue def del elif else except finally for from global if import in is "
    "lambda nonlocal not or pass raise return try while with yield".split()
)
_TOKEN = re.compile(
    r"""(?P<blank>[ \t\f]+|\\\r?\n)|(?P<comment>\#[^\n]*)|(?P<newline>\r?\n|\r)
    |(?P<string>(?i:[rbuft]|br|rb|fr|rf|tr|rt)?(?:\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|\"(?!\"\")(?:[^\\\"\n]|\\(?:\r\n|.))*\"|'(?!'')(?:[^\\'\n]|\\(?:\r\n|.))*'))
    |(?P<number>(?:0[xX](?:_?[0-9a-fA-F])+|0[bB](?:_?[01])+|0[oO](?:_?[0-7])+|(?:(?:[0-9](?:_?[0-9])*)?\.[0-9](?:_?[0-9])*|[0-9](?:_?[0-9])*\.?)(?:[eE][-+]?[0-9](?:_?[0-9])*)?[jJ]?)(?![\w]))
    |(?P<name>[^\W\d]\w*)
    |(?P<op>\*\*=|//=|>>=|<<=|\.\.\.|:=|->|==|!=|<=|>=|\*\*|//|>>|<<|\+=|-=|\*=|/=|%=|&=|\|=|\^=|@=|[-+*/%@&|^~<>()\[\]{},:.;=])""",
    re.X | re.S,
)


_F_START = re.compile(r"(?i:[ft]|[ft]r|r[ft])(\"\"\"|\'\'\'|\"|\')")
_ANY_START = re.compile(r"(?i:[rbuft]|br|rb|fr|rf|tr|rt)?(\"\"\"|\'\'\'|\"|\')")
_ESCAPE = re.compile(r"\\(?:x(?P<x>[0-9a-fA-F]{2})?|u(?P<u>[0-9a-fA-F]{4})?|U(?P<U>(?:000[0-9a-fA-F]|0010)[0-9a-fA-F]{4})?|N(?P<N>\{[^{}\n]+\})?|.)", re.S)
_ZEROS = re.compile(r"0[0-9_]*[1-9][0-9_]*")
_STRING_HEAD = re.compile(r"([A-Za-z]*)(\"\"\"|\'\'\'|\"|\')")
_MARK = re.compile(r"\s*=\s*(?=[!:}])")


def _bad_escape(text: str, octets: bool = False) -> bool:
    """Whether a literal's text, raw ones apart, holds an escape that names nothing."""
    if "\\" not in text:
        return False
    for m in _ESCAPE.finditer(text):
        kind = m.group()[1:2]
        if kind not in ("x", "u", "U", "N") or (octets and kind != "x"):
            continue
        value = m.group(kind)
        if value is None:
            return True
        if kind == "N":
            try:
                unicodedata.lookup(value[1:-1])
            except KeyError:
                return True
    return False


def _field(text: str, at: int) -> int:
    """End, after its brace, of the field of a formatted string that begins at ``at``; -1 if it is none: an expression,
    perhaps ``=``, a conversion and a format with fields of its own."""
    begin, depth, n = at, 0, len(text)
    while at < n:
        c = text[at]
        s = _ANY_START.match(text, at)
        if s and not (at and (text[at - 1].isalnum() or text[at - 1] == "_")):
            if _F_START.match(text, at):
                at = _f_string(text, _F_START.match(text, at))
            else:
                e = _TOKEN.match(text, at)
                at = e.end() if e and e.lastgroup == "string" else -1
            if at < 0:
                return -1
            continue
        if c == "#":
            e = text.find("\n", at)
            at = n if e < 0 else e
            continue
        if not depth and (c in ":}" or (c == "!" and text[at + 1 : at + 2] != "=") or (c == "=" and _MARK.match(text, at) and text[at - 1] not in "=!<>")):
            break
        depth += (c in "{[(") - (c in "}])")
        if depth < 0:
            return -1
        at += 1
    if at >= n or not _is_field(text[begin:at]):
        return -1
    if (m := _MARK.match(text, at)) is not None:
        at = m.end()
    if text[at] == "!":
        m = re.compile(r"![sra]\s*(?=[:}])").match(text, at)
        if not m:
            return -1
        at = m.end()
    if text[at] == ":":
        at += 1
        while at < n and text[at] != "}":
            if text[at] == "{":
                at = _field(text, at + 1)
                if at < 0:
                    return -1
            else:
                at += 1
    return at + 1 if at < n and text[at] == "}" else -1


def _is_field(expression: str) -> bool:
    """Whether the grammar takes the text, with line ends as blanks, as the expression of a field."""
    if not expression.strip():
        return False
    try:
        # in parentheses, so that line ends do not count
        kinds, values, _ = python_tokens("(" + expression + "\n)")
    except NotTokens:
        return False
    inner = (kinds[1:-3] + ["END"], values[1:-3] + [""])
    return kinds[-3:] == ["op", "NEWLINE", "END"] and FIELD.parse(inner) == len(inner[0])


def _f_string(text: str, m: re.Match) -> int:
    """End of the formatted string that begins at ``m``: fields in braces may hold strings with the same quotes; -1 if it
    does not close or a field is none."""
    quote, at, n = m.group(1), m.end(), len(text)
    raw = "r" in m.group().lower()
    while at < n:
        c = text[at]
        if text.startswith(quote, at):
            return at + len(quote)
        if c == "\\":
            if raw:
                at += 1 if text[at + 1 : at + 2] in ("{", "}") else 2
                continue
            e = _ESCAPE.match(text, at)
            if not e or _bad_escape(e.group()):
                return -1
            at = at + 1 if text[at + 1 : at + 2] in ("{", "}") else e.end()
        elif c in "{}" and text[at + 1 : at + 2] == c:
            at += 2
        elif c == "{":
            at = _field(text, at + 1)
            if at < 0:
                return -1
        elif c == "}" or (c == "\n" and len(quote) == 1):
            return -1
        else:
            at += 1
    return -1


class NotTokens(ValueError):
    def __init__(self, at: int, want: str) -> None:
        super().__init__(want)
        self.at, self.want = at, want


def python_tokens(text: str) -> tuple[list[str], list[str], list[int]]:
    """(kinds, values, offsets) with NEWLINE, INDENT and DEDENT; raises NotTokens where no token can begin."""
    kinds, values, offsets = [], [], []
    stack, depth, at, fresh = [(0, 0)], 0, 1 if text.startswith("\ufeff") else 0, True
    n, match = len(text), _TOKEN.match
    open_: list[str] = []

    def put(kind: str, value: str, where: int) -> None:
        kinds.append(kind)
        values.append(value)
        offsets.append(where)

    while at < n:
        if fresh and not depth:
            m = re.compile(r"[ \t\f]*").match(text, at)
            # a block must stand as deep whether a tab goes to the next eighth column or counts one
            blanks = m.group().rpartition("\f")[2]
            width = (len(blanks.expandtabs(8)), len(blanks))
            at = m.end()
            if at >= n:
                break
            if text[at] not in "#\r\n" and not text.startswith(("\\\n", "\\\r\n"), at):
                if width[0] > stack[-1][0] and width[1] > stack[-1][1]:
                    stack.append(width)
                    put("INDENT", "", at)
                while width[0] < stack[-1][0]:
                    stack.pop()
                    put("DEDENT", "", at)
                if width != stack[-1]:
                    raise NotTokens(at, "indentation of an outer block")
                fresh = False
        if (f := _F_START.match(text, at)) is not None:
            end = _f_string(text, f)
            if end < 0:
                raise NotTokens(at, "a formatted string")
            put("STRING", text[at:end], at)
            at = end
            continue
        m = match(text, at)
        if not m:
            raise NotTokens(at, "a token")
        kind, value = m.lastgroup, m.group()
        if kind == "newline":
            if not depth and not fresh:
                put("NEWLINE", "", at)
            fresh = fresh or not depth
        elif kind == "op":
            if value in "([{":
                open_.append(value)
            elif value in ")]}":
                if not open_ or "([{".index(open_.pop()) != ")]}".index(value):
                    raise NotTokens(at, "the bracket that was opened")
            depth = len(open_)
            put("op", value, at)
        elif kind == "name":
            put("op" if value in KEYWORDS else "NAME", value, at)
        elif kind == "string":
            head = _STRING_HEAD.match(value).group(1).lower()
            if "b" in head and not value.isascii():
                raise NotTokens(at, "bytes of ASCII")
            if "r" not in head and _bad_escape(value, "b" in head):
                raise NotTokens(at, "an escape that names a character")
            put("STRING", value, at)
        elif kind == "number":
            if _ZEROS.fullmatch(value):
                raise NotTokens(at, "a number without leading zeros")
            put("NUMBER", value, at)
        at = m.end()
    for k, (a, b) in enumerate(zip(kinds, kinds[1:])):
        if a == b == "STRING" and ("b" in _STRING_HEAD.match(values[k]).group(1).lower()) != ("b" in _STRING_HEAD.match(values[k + 1]).group(1).lower()):
            raise NotTokens(offsets[k + 1], "bytes beside bytes, or text beside text")
    if depth:
        raise NotTokens(n, "a closing bracket")
    if kinds and kinds[-1] not in ("NEWLINE", "DEDENT"):
        put("NEWLINE", "", n)
    for _ in stack[1:]:
        put("DEDENT", "", n)
    put("END", "", n)
    return kinds, values, offsets


def _over_tokens(g: Packrat, name: str, literal: bool) -> Step:
    def run(p: int) -> int:
        kinds, values = g.data
        # soft keywords are names with a known spelling
        if (values[p] == name and kinds[p] in ("op", "NAME")) if literal else kinds[p] == name:
            return p + 1
        if p > g.far:
            g.far, g.want = p, name
        return -1

    return run


_PYTHON = """
file <- statement* ~END~
statement <- compound / simple
simple <- small (';' small)* ';'? ~NEWLINE~
small <- 'pass' / 'break' / 'continue' / 'return' results? / 'raise' (expr ('from' expr)?)? / import / 'del' targets / 'assert' expr (',' expr)? / 'global' ~NAME~ (',' ~NAME~)* / 'nonlocal' ~NAME~ (',' ~NAME~)* / alias / assignment / yield / results
alias <- 'type' ~NAME~ typeparams? '=' expr
assignment <- target ':' expr ('=' (yield / results))? / (targets '=')+ (yield / results) !'=' / target augmented (yield / results)
augmented <- '+=' / '-=' / '*=' / '/=' / '//=' / '%=' / '**=' / '&=' / '|=' / '^=' / '<<=' / '>>=' / '@='
targets <- starget (',' starget)* ','?
starget <- '*' target / target
target <- primary_target / ~NAME~ !trailer / '(' targets? ')' !trailer / '[' targets? ']' !trailer
primary_target <- atom (trailer &trailer)* ('.' ~NAME~ / '[' slices ']') !trailer
import <- 'import' dotted ('as' ~NAME~)? (',' dotted ('as' ~NAME~)?)* / 'from' ('.' / '...')* dotted 'import' imported / 'from' ('.' / '...')+ 'import' imported
imported <- '*' / '(' names ','? ')' / names
names <- ~NAME~ ('as' ~NAME~)? (',' ~NAME~ ('as' ~NAME~)?)*
dotted <- ~NAME~ ('.' ~NAME~)*
compound <- if / while / for / try / with / decorated / def / class / 'async' (def / for / with) / match
block <- ~NEWLINE~ ~INDENT~ statement+ ~DEDENT~ / simple
if <- 'if' named ':' block ('elif' named ':' block)* else?
else <- 'else' ':' block
while <- 'while' named ':' block else?
for <- 'for' targets 'in' results ':' block else?
try <- 'try' ':' block (except+ else? finally? / finally)
except <- 'except' '*'? (results ('as' ~NAME~)?)? ':' block
finally <- 'finally' ':' block
with <- 'with' ('(' withitem (',' withitem)* ','? ')' ':' / withitem (',' withitem)* ':') block
withitem <- expr ('as' starget)?
decorated <- ('@' named ~NEWLINE~)+ (def / class / 'async' def)
def <- 'def' ~NAME~ typeparams? '(' params? ')' ('->' expr)? ':' block
typeparams <- '[' typeparam (',' typeparam)* ','? ']'
typeparam <- ('*' / '**')? ~NAME~ (':' expr)? ('=' expr)?
params <- plain (',' starred)? ','? / starred ','?
plain <- reqs ',' '/' (',' req)* (',' opt)* / reqs (',' opt)+ ',' '/' (',' opt)* / opts ',' '/' (',' opt)* / reqs (',' opt)* / opts
reqs <- req (',' req)*
opts <- opt (',' opt)*
req <- ~NAME~ (':' expr)? !'='
opt <- ~NAME~ (':' expr)? '=' expr
starred <- '*' ~NAME~ (':' ('*' expr / expr))? (',' either)* (',' rest)? / '*' (',' either)+ (',' rest)? / rest
either <- ~NAME~ (':' expr)? ('=' expr)?
rest <- '**' ~NAME~ (':' expr)?
class <- 'class' ~NAME~ typeparams? ('(' args? ')')? ':' block
match <- 'match' exprs ':' ~NEWLINE~ ~INDENT~ case+ ~DEDENT~
case <- 'case' patterns ('if' named)? ':' block
patterns <- pattern (',' pattern)* ','?
pattern <- '*' ~NAME~ / orpattern ('as' ~NAME~)?
orpattern <- closed ('|' closed)*
closed <- '-'? ~NUMBER~ (('+' / '-') ~NUMBER~)? / ~STRING~+ / 'None' / 'True' / 'False' / dotted ('(' (argpattern (',' argpattern)* ','?)? ')')? / '(' patterns? ')' / '[' patterns? ']' / '{' (mappattern (',' mappattern)* ','?)? '}'
argpattern <- ~NAME~ '=' pattern / pattern
mappattern <- '**' ~NAME~ / closed ':' pattern
results <- result (',' result)* ','?
result <- '*' arith / expr !':='
exprs <- sexpr (',' sexpr)* ','?
sexpr <- '*' arith / named
named <- ~NAME~ ':=' expr / expr !':='
expr <- lambda / bool ('if' bool 'else' expr)?
lambda <- 'lambda' lparams? ':' expr
lparams <- lplain (',' lstarred)? ','? / lstarred ','?
lplain <- lreqs ',' '/' (',' lreq)* (',' lopt)* / lreqs (',' lopt)+ ',' '/' (',' lopt)* / lopts ',' '/' (',' lopt)* / lreqs (',' lopt)* / lopts
lreqs <- lreq (',' lreq)*
lopts <- lopt (',' lopt)*
lreq <- ~NAME~ !'='
lopt <- ~NAME~ '=' expr
lstarred <- '*' ~NAME~ (',' leither)* (',' lrest)? / '*' (',' leither)+ (',' lrest)? / lrest
leither <- ~NAME~ ('=' expr)?
lrest <- '**' ~NAME~
bool <- 'not'* compare (('and' / 'or') 'not'* compare)*
compare <- arith (comparison arith)*
comparison <- '==' / '!=' / '<=' / '>=' / '<' / '>' / 'in' / 'not' 'in' / 'is' 'not' / 'is'
arith <- unary (operator unary)*
operator <- '+' / '-' / '*' / '/' / '//' / '%' / '@' / '**' / '<<' / '>>' / '&' / '|' / '^'
unary <- ('+' / '-' / '~')* 'await'? primary
primary <- atom trailer*
trailer <- '.' ~NAME~ / '(' named comp ')' / '(' args? ')' / '[' slices ']'
slices <- slice (',' slice)* ','?
slice <- expr? ':' expr? (':' expr?)? / sexpr
args <- posarg (',' posarg)* (',' kwargs)? ','? / kwargs ','?
posarg <- '*' expr / ~NAME~ ':=' expr / expr !':=' !'='
kwargs <- kwstar (',' kwstar)* (',' kwdouble (',' kwdouble)*)? / kwdouble (',' kwdouble)*
kwstar <- ~NAME~ '=' expr / '*' expr
kwdouble <- ~NAME~ '=' expr / '**' expr
comp <- ('async'? 'for' targets 'in' bool ('if' (lambda / bool))*)+
yield <- 'yield' ('from' expr / results)?
atom <- ~NAME~ / ~NUMBER~ / ~STRING~+ / 'None' / 'True' / 'False' / '...' / '(' (yield / named comp / exprs)? ')' / '[' (named comp / exprs)? ']' / '{' (pair comp / entry (',' entry)* ','? / named comp / exprs)? '}'
entry <- '**' arith / pair
pair <- expr ':' expr
field <- (yield / exprs) ~END~
"""
PYTHON = Packrat(_PYTHON, "file", _over_tokens)
FIELD = Packrat(_PYTHON, "field", _over_tokens)  # fields of formatted strings, while the tokens are made

_VERBATIM = re.compile(r"\\begin\{(verbatim\*?|Verbatim|lstlisting|minted|comment)\}.*?\\end\{\1\}", re.S)
_CONFLICT = re.compile(r"^(?:<{7}|={7}|>{7}|\|{7})(?=[ \t\r]|$)", re.M)
_COMMAND = re.compile(r"\\[A-Za-z]+")
_STATEMENT = frozenset(("=", "def", "class", "import", "from", "for", "while", "if", "with", "try", "return", "assert", "del", "raise"))


def _python(text: str) -> tuple[bool, int, str]:
    try:
        kinds, values, offsets = python_tokens(text)
    except NotTokens as e:
        return False, e.at, e.want
    ok = PYTHON.parse((kinds, values)) == len(kinds)
    return ok, len(text) if ok else offsets[max(0, PYTHON.far)], "" if ok else PYTHON.want


def other_language(text: str) -> str | None:
    """The language, other than LaTeX, whose grammar consumes all of a text: one JSON object or array, ``KEY=value`` lines
    alone, or Python with a statement that is more than an expression. A text with a LaTeX command outside comments is
    none of these unless the grammar has it inside its strings."""
    bare = text.strip()
    if not bare:
        return None
    if bare[0] in "{[" and bare[-1] in "}]" and JSON.parse(text) == len(text):
        return "json"
    if "=" in bare and CONF.parse(text) == len(text):
        return "conf"
    # an indented copy is the same language
    words = set(re.findall(r"\w+|=", bare))
    return "py" if words & _STATEMENT and _python(text)[0] else None


def check(suffix: str | None, text: str) -> tuple[bool, int, str, bool] | None:
    """(valid, furthest failure, what was expected there, conflict lines left) of one text; None for another language."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000 + 24 * len(text)))
    conflict = _CONFLICT.search(text)
    if conflict and suffix == "tex":  # verbatim text may show markers
        conflict = _CONFLICT.search(_VERBATIM.sub(lambda m: " " * len(m.group()), text))
    if suffix == "py":
        return *_python(text), conflict is not None
    if suffix in ("json", "conf"):
        g = JSON if suffix == "json" else CONF
        ok = g.parse(text) == len(text)
        return ok, len(text) if ok else max(0, g.far), "" if ok else g.want, conflict is not None
    if suffix == "tex":
        if (name := other_language(text)) is not None:
            return False, 0, f"LaTeX, not {name}", conflict is not None
        ok = LATEX.parse(text) == len(text)
        if conflict and (ok or conflict.start() <= LATEX.far):
            return False, conflict.start(), "no conflict marker", True
        return ok, len(text) if ok else max(0, LATEX.far), "" if ok else LATEX.want, conflict is not None
    return None
