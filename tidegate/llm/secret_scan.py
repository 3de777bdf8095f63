"""Secrets in source and configuration text: patterns, and literals given to sensitive names."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import ship_package

#: The base patterns by kind, in the order of the kinds, and the least length of the
#: whole match, or of group 2 where there is one. (A run of 24 or more is matched as such: shorter
#: runs would be dropped.)
BASE = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII | re.IGNORECASE,
        ),
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 24),
)
#: What the lexer adds.
LITERAL = "literal"
KINDS = (*(kind for kind, _, _ in BASE), LITERAL)
#: Score from which a literal is reported.
THRESHOLD = 0.5

#: How much a word, or a pair of words, of a name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "secrets": 0.9,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "pin": 0.6,
    "signature": 0.6, "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0,
    "encryption key": 1.0, "signing key": 1.0, "master key": 1.0, "auth key": 1.0, "account key": 1.0,
    "client secret": 1.0, "connection string": 0.8, "auth": 0.7, "pass": 0.7, "salt": 0.6,
}
#: Last words of names that tell about a secret and don't hold it.
ABOUT = frozenset(
    "url uri path file name id type field label hint length len count size policy regex pattern "
    "expires expiry ttl min max prefix header endpoint format enabled required reset prompt".split()
)
_PLACEHOLDER = re.compile(
    r"change.?me|example|placeholder|redacted|dummy|your[-_ ]|todo|\bxxx|^x+$|^\*+$|^\.+$|"
    r"^(?:none|null|true|false|undefined|string|password|secret|test)$|^\$?\{|^<.*>$|^%\w|\{\{|\$\(",
    re.IGNORECASE,
)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+|[^\W\d_A-Za-z]+")

# The lexer's patterns never go back over a run of characters (possessive repeats), and start
# names at their first character only: time stays in proportion to the text.
_ASSIGN = re.compile(
    r"""(?<![\w$.\-])(?P<q>["'`]?)(?P<name>[^\W\d]|[$@])(?P<rest>[\w$.\-]*+(?:->[\w$]++)*+)(?P=q)\]?"""
    r"""(?:[ \t]*+:[ \t]*+[\w.\[\]|]++(?=[ \t]*+=[^=]))?"""  # a type
    r"""[ \t]*+(?P<op>:=|=>|\?=|\+=|=(?![=~>])|:(?![:/=]))[ \t]*+"""
)
_STRING = re.compile(
    r'''[rbuf]{0,2}(?:"""(?P<a>(?:[^"\\]|\\.|"(?!""))*+)"""|\'\'\'(?P<b>(?:[^'\\]|\\.|'(?!''))*+)\'\'\''''
    r'''|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>(?:[^`\\\n]|\\.)*+)`)''',
    re.IGNORECASE | re.DOTALL,
)
_NAME = re.compile(r"\$?\{?(?P<name>[^\W\d][\w$.]*+(?:->[\w$]++)*+)\}?(?=[\s;,)+(&.]|\Z)")
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>|&]++""")
_JOIN = re.compile(r"[ \t]*+(?:\+|\.\.?(?=[ \t\"'$])|\\\n)\s*+")
_ARGUMENT = re.compile(r"(?P<closed>[\s)]*+)[,+]\s*+")
_CALL = re.compile(
    r"""\([ \t]*+(?P<p>["'])(?P<name>[\w$.\-]++)(?P=p)[ \t]*+,[ \t]*+(?=["'`])"""
)
_ELEMENT = re.compile(r"<(?P<name>[\w.:\-]++)(?:[ \t][^<>\n]*+)?>(?=[^<>\n]++</(?P=name)>)")
_BLOCK = re.compile(r"[|>][+-]?[ \t]*+\n")
_LINE = re.compile(r"([ \t]*+)([^\n]*+)\n?")


@dataclass
class _Definition:
    """One name-literal pair: a name, the literals given to it and the names it takes them from."""

    name: str
    literals: list[tuple[int, int]] = field(default_factory=list)
    uses: list[int] = field(default_factory=list)
    bits: float = 0.0


def name_weight(name: str) -> float:
    """0 to 1: how likely a value of this name is secret."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in ABOUT or words[0] in ("public", "is", "has"):
        return 0.0
    pairs = [" ".join(p) for p in zip(words, words[1:])]
    return max(SENSITIVE.get(w, 0.0) for w in words + pairs)


def literal_bits(value: str, quoted: bool = True) -> float:
    """Information that a literal seems to hold; 0 for placeholders, prose and bare words."""
    if len(value) < 2 or _PLACEHOLDER.search(value):
        return 0.0
    classes = sum(any(map(test, value)) for test in (str.islower, str.isupper, str.isdigit))
    if not quoted and (classes < 2 or len(value) < 6 or not any(map(str.isdigit, value))):
        return 0.0
    size = len(value)
    bits = -sum(n * math.log2(n / size) for n in Counter(value).values())
    if value.startswith(("/", "./", "http://", "https://")) and "@" not in value:
        return bits / 8
    # Words in a row are prose, unless the name asks for such a value and it is short.
    return bits / (4 if len(value.split()) > 4 and "KEY-----" not in value else 1)


def _score(weight: float, bits: float) -> float:
    return weight * (1 - math.exp(-bits / 12))


def find(text: str, threshold: float = THRESHOLD) -> list[tuple[int, str, int, str, float]]:
    """``(start, kind, end, name, score)`` of every secret in a text, by start, then kind.

    Literals that lie within the span of a base pattern are not reported again.
    """
    found = []
    for order, (kind, pattern, least) in enumerate(BASE):
        for match in pattern.finditer(text):
            start, end = match.span(pattern.groups)
            if end - start >= least:
                found.append((match.start(), order, match.end(), match[1] if pattern.groups else "", 1.0))
    if any(c in text for c in "=:,<"):
        # Nothing but their largest end so far is asked of earlier spans.
        starts = sorted((start, end) for start, _, end, _, _ in found)
        at, covered, extra = 0, 0, []
        for start, end, name, score in sorted(literals(text)):
            while at < len(starts) and starts[at][0] <= start:
                covered = max(covered, starts[at][1])
                at += 1
            if score >= threshold and end > covered:
                extra.append((start, len(BASE), end, name, score))
        found += extra
    found.sort()
    return [(start, KINDS[kind], end, name, score) for start, kind, end, name, score in found]


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, score)`` of each literal: of the most sensitive name that it reaches.

    Definitions are read in text order; a name stands for its latest definition. One pass forward adds
    up what each definition's literals hold, one pass back hands the score of a name to all that
    flows into it.
    """
    definitions = _definitions(text)
    scores = [_score(name_weight(d.name), d.bits) for d in definitions]
    names = [d.name for d in definitions]
    out: dict[tuple[int, int], tuple[float, str]] = {}
    for i in range(len(definitions) - 1, -1, -1):
        for j in definitions[i].uses:
            if scores[i] > scores[j]:
                scores[j], names[j] = scores[i], names[i]
        for span in definitions[i].literals:
            if scores[i] > out.get(span, (0.0, ""))[0]:
                out[span] = scores[i], names[i]
    return [(start, end, name, score) for (start, end), (score, name) in out.items()]


def _definitions(text: str) -> list[_Definition]:
    places = [(m.end(), m["name"] + m["rest"], m["op"], m.start()) for m in _ASSIGN.finditer(text)]
    places += [(m.end(), m["name"], ",", m.start()) for m in _CALL.finditer(text)]
    places += [(m.end(), m["name"], "<", m.start()) for m in _ELEMENT.finditer(text)]
    places.sort()
    latest: dict[str, int] = {}
    out: list[_Definition] = []
    label = (-1, "")
    read = bare = 0
    for at, name, op, start in places:
        if start < bare:
            continue  # part of a bare value
        own = _Definition(name.removeprefix("$"))
        if op == "<":
            spans = [(at, text.index("<", at), True)]
        elif op == ":" and _BLOCK.match(text, at):
            spans = [(*_block(text, start, at), True)]
        else:
            # Within a value that has been read, one word or string each: no text is read often.
            spans, end = _expression(text, at, op == "," or start < read)
            read = max(read, end)
            bare = end if spans and spans[0][2] is False else bare
        for span_start, end, kind in spans:
            value = text[span_start:end]
            if kind is None:  # a name, or a bare value that looks like one
                shape = _NAME.match(text, span_start)
                known = latest.get(shape["name"]) if shape else None
                if known is not None:
                    own.uses.append(known)
                    own.bits += out[known].bits
                    continue
            bits = literal_bits(value, bool(kind))
            if bits:
                own.literals.append((span_start, end))
                own.bits += bits
        own.bits = min(own.bits, 1e6)  # a name may be doubled again and again
        if op == "+=" and own.name in latest:
            own.uses.append(latest[own.name])
            own.bits = min(own.bits + out[latest[own.name]].bits, 1e6)
        # {"name": "DB_PASSWORD", "value": "..."} and <add key="..." value="..."/>
        word = own.name.lower()
        if word in ("value", "val") and at - label[0] < 200 and label[1]:
            own.name = label[1]
        elif word in ("name", "key", "id") and len(spans) == 1 and spans[0][2]:
            label = (at, text[spans[0][0] : spans[0][1]])
        latest[own.name] = len(out)
        out.append(own)
    return out


def _expression(text: str, at: int, single: bool) -> tuple[list[tuple[int, int, bool | None]], int]:
    """Literals (True if quoted) and names (None) of the value that starts at ``at``, and its end.

    Strings next to each other or joined by an operator are one value; so are the arguments of a
    call. ``single`` reads one string or word.
    """
    parts: list[tuple[int, int, bool | None]] = []
    depth = 0
    while True:
        match = _STRING.match(text, at)
        if match:
            parts.append((*match.span(match.lastgroup), True))
        else:
            match = _NAME.match(text, at)
            if match and text.startswith("(", match.end()) and not single:
                depth += 1
                at = _blank(text, match.end() + 1)
                continue
            if match:
                parts.append((*match.span(), None))
            else:
                # Bare values stand alone.
                match = None if parts or depth else _BARE.match(text, at)
                if not match:
                    return parts, at
                return [(*match.span(), False)], match.end()
        at = match.end()
        if single:
            return parts, at
        join = _JOIN.match(text, at) or (_ARGUMENT.match(text, at) if depth else None)
        if join:
            depth -= (join.groupdict().get("closed") or "").count(")")
            if depth < 0:
                return parts, at
            at = join.end()
        elif parts[-1][2] and _STRING.match(text, _blank(text, at)):
            at = _blank(text, at)
        else:
            return parts, at


def _blank(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t":
        at += 1
    return at


def _block(text: str, start: int, at: int) -> tuple[int, int]:
    """Span of the lines below ``at`` that are indented more than the line of ``start``."""
    line = text.rfind("\n", 0, start) + 1
    indent = len(_LINE.match(text, line)[1])
    at = first = text.index("\n", at) + 1
    end = at
    while at < len(text):
        match = _LINE.match(text, at)
        if match[2].strip() and len(match[1]) <= indent:
            break
        at = match.end()
        end = match.end(2) if match[2].strip() else end
    return (_blank(text, first), end) if end > first else (first, first)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``(id_col, findings)``: all secrets of each row's whole text, by start, then kind.

    A finding has ``kind, start, end`` (code points, end exclusive), ``name`` (what the value is
    given to; empty without) and ``score``. Kinds ``assign``, ``access`` and ``hex`` are the base
    patterns, score 1. Kind ``literal`` is what the lexer adds: literals of assignments (of
    source code, JSON, YAML, INI and XML), followed through names and concatenations to the most
    sensitive name they reach, whose weight times the literal's information is the score.

    Rows are kept one for one; a null or empty text has no findings, ids may be null or repeat, an
    empty table gives no rows, other columns are ignored. Texts are read whole, in time that
    follows their length; a row is one document's own work, and nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    shape = T.StructType(
        [T.StructField(n, t) for n, t in (
            ("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()),
            ("name", T.StringType()), ("score", T.DoubleType()),
        )]
    )
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("findings", T.ArrayType(shape))]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scanner(threshold), schema).withColumnRenamed("id", id_col)


def _scanner(threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())]
        shape = pa.list_(pa.struct(fields))
        for batch in batches:
            found = []
            for text in batch.column(1):
                secrets = find(text.as_py() or "", threshold)
                found.append([dict(zip(("start", "kind", "end", "name", "score"), s)) for s in secrets])
            yield pa.record_batch([batch.column(0), pa.array(found, shape)], ["id", "findings"])

    return run
