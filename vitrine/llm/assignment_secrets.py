"""Secret scan: fixed patterns, and an assignment-aware lexer that judges literals by the names they are given.

Base findings (kinds assign, access, hex) are the leftmost non-overlapping
matches of three fixed patterns.  The lexer adds findings of kind `literal`:

* every `=`, `:=`, `:`, `=>` that assigns is read back to its target (identifier,
  dotted name, quoted key, subscript, annotated or typed declaration) and forward
  over its value: quoted literals with escapes, bare configuration values,
  names, and sums of these;
* names defined by such a value are constants, and a later (or earlier) use of
  the name stands for their literals;
* a literal is scored by how sensitive its target's words are and by how much it
  looks like a key, a private key block or a passphrase rather than like prose or
  a placeholder.

A map over documents; values are read whole, whatever their length, in time
linear in the text; a target lies within LOOK characters before its operator.  Defined results: null text is empty and
has no findings; positions are code points, ends exclusive; repeated rows
repeat their result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.shipping import ship_package

KINDS = ("assign", "access", "hex", "literal")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# the task's patterns; only the letters of the first group are of either case
_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that have 32 or more

#: how far before its operator a target is read, and the score from which a literal is reported
LOOK, THRESHOLD = 200, 0.5
#: words of target names and how sensitive they make the name
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 1.0, "credential": 0.9,
             "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "auth": 0.6, "bearer": 0.7, "signature": 0.5, "salt": 0.5}
#: pairs of words that are sensitive together
PAIRS = {("api", "key"), ("private", "key"), ("access", "key"), ("secret", "key"), ("encryption", "key"), ("signing", "key"), ("client", "secret"), ("connection", "string")}
PLACEHOLDER = re.compile(r"(?i)^(?:.*(?:example|changeme|change_me|placeholder|your[_-]|dummy|xxxx|todo).*|none|null|true|false|undefined|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|(.)\1*)$")

#: a word of these in a literal of several words tells prose from a passphrase
PROSE = {"the", "a", "an", "of", "to", "is", "are", "be", "must", "your", "please", "enter", "for", "and", "or", "not", "in", "with", "this", "that", "password", "passphrase"}
#: target words whose literal may be a phrase, and the words from which a phrase counts fully
PHRASE_NAMES, PHRASE_WORDS = {"password", "passwd", "passphrase", "pwd"}, 4

MARKED = re.compile(r"(?i)example|changeme|change_me|placeholder|your[_-]|dummy|xxxx|todo")
_OPERATOR = re.compile(r"=>|:=|[:=]")
_TARGET = re.compile(r"""(?:([A-Za-z_$][\w$.\-]*)|["']([^"'\n]{1,80})["']|\[\s*["']([^"'\n]{1,80})["']\s*\])\s*$""")
_ANNOTATED = re.compile(r"([A-Za-z_$][\w$]*)[ \t]*:[ \t]*[A-Za-z_][\w.\[\], |]*$")
_QUOTED = re.compile(r'''"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\\n]|\\.)*+)`''')
# possessive: a name is not cut out of a longer value
_NAME = re.compile(r"[A-Za-z_$][\w$]*+(?:\.[A-Za-z_$][\w$]*+)*+(?![\w$(\[+/=\-!@#%^*~]|\.[A-Za-z0-9+/_=\-])")
_BARE = re.compile(r"[A-Za-z0-9+/_.=\-!@#$%^&*~]+")
# a block may stand in (triple) quotes, below a YAML bar, or bare; its body has no five dashes
_PEM = re.compile(r"""["'`]{0,3}(?:[|>][+-]?)?\s*(-----BEGIN [A-Z0-9 ]++-----[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z0-9 ]++-----)""")
_BLANKS = re.compile(r"[ \t]*")
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*\n?[ \t]*")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


class Finding(NamedTuple):
    kind: str
    start: int
    end: int
    name: str
    score: float


def base_findings(text: str) -> list[Finding]:
    out = [Finding("assign", m.start(), m.end(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [Finding("access", m.start(), m.end(), "", 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [Finding("hex", m.start(), m.end(), "", 1.0) for m in HEX.finditer(text)]


def name_weight(name: str) -> float:
    """How sensitive a target name is: its words split at case, digits and punctuation."""
    words = [w.lower() for w in _PARTS.findall(name)]
    weight = max((SENSITIVE.get(w, 0.0) for w in [*words, *("".join(p) for p in zip(words, words[1:]))]), default=0.0)
    return max(weight, 0.9 if any(p in PAIRS for p in zip(words, words[1:])) else 0.0)


def _key_weight(counts: Counter) -> float:
    """How much characters look like a key's: their number, spread and kinds."""
    n = sum(counts.values())
    bits = -sum(k / n * math.log2(k / n) for k in counts.values())
    kinds = sum((any(c.islower() for c in counts), any(c.isupper() for c in counts), any(c.isdigit() for c in counts), any(not c.isalnum() for c in counts)))
    return min(1.0, bits / 3.5) * (0.5 + 0.5 * min(1.0, (kinds - 1) / 2 + n / 64))


def literal_weight(value: str, phrase: bool = False) -> float:
    """How much a literal looks like a key: length, spread of characters, kinds of characters; 0 for placeholders and prose.

    Of several words: a private key block counts fully, a phrase (where the name
    allows one) by its distinct words, else the likeliest word that has a digit.
    """
    if len(value) < 8 or PLACEHOLDER.match(value):
        return 0.0
    words = value.split()
    if words == [value]:
        return _key_weight(Counter(value))
    if "-----BEGIN " in value:
        return 1.0 if "PRIVATE KEY-----" in value else 0.0
    best = max((literal_weight(w) for w in words if any(c.isdigit() for c in w)), default=0.0)
    lower = {w.strip(",;:.!?").lower() for w in words}
    if phrase and len(lower) > 1 and not lower & PROSE:
        best = max(best, min(1.0, len(lower) / PHRASE_WORDS))
    return best


def _tail_weights(text: str, starts: list[int], end: int) -> dict[int, float]:
    """literal_weight of text[start:end] for several starts in one bare value, adding up from its end."""
    out, counts, above, marked = {}, Counter(), end, False
    for start in sorted(starts, reverse=True):
        counts.update(text[start:above])
        marked = marked or MARKED.search(text, start, min(end, above + 16)) is not None
        above = start
        if end - start < 64:
            out[start] = literal_weight(text[start:end])
        else:
            first, last = text[start], text[end - 1]
            whole = first == last == "%" or len(counts) == 1
            out[start] = 0.0 if marked or whole else _key_weight(counts)
    return out


class _Assignment(NamedTuple):
    name: str
    terms: list[tuple[str, int, int]]  # ("text", "bare" or "name", start, end)


def assignments(text: str) -> Iterator[_Assignment]:
    """Name and value terms of every assignment, in order."""
    bare = 0  # end of the bare run read last
    for op in _OPERATOR.finditer(text):
        i, j = op.span()
        if text[j: j + 1] == "=" or text[j: j + 2] == "//" or (op[0] == "=" and text[i - 1: i] in ("=", "!", "<", ">")) or (op[0] == ":" and ":" in (text[i - 1: i], text[j: j + 1])):
            continue
        before = text[max(0, i - LOOK): i]
        line = before[before.rfind("\n") + 1:]
        target = (_ANNOTATED.search(line) if op[0] == "=" else None) or _TARGET.search(line)
        if not target:
            continue
        name = next(x for x in target.groups() if x)
        after = _BLANKS.match(text, j).end()
        terms = []
        while True:
            if (m := _PEM.match(text, after)) or (m := _QUOTED.match(text, after)):
                k, end = m.lastindex, m.end()
                terms.append(("text", m.start(k), m.end(k)))
            elif m := _NAME.match(text, after):
                end = m.end()
                terms.append(("name", after, end))
            elif not terms and (after < bare or _BARE.match(text, after, after + 1)):
                end = bare = bare if after < bare else _BARE.match(text, after).end()
                terms.append(("bare", after, end))
            else:
                break
            plus = _PLUS.match(text, end)
            if not plus:
                break
            after = plus.end()
        if terms:
            yield _Assignment(name, terms)


def literal_findings(text: str) -> list[Finding]:
    """Literals given, directly or through constants, to sensitive names."""
    found = list(assignments(text))
    constants = {}
    for a in found:
        constants.setdefault(a.name.rpartition(".")[2], a.terms)
    judged, tails = [], {}
    for a in found:
        weight = name_weight(a.name)
        if weight <= 0:
            continue
        parts, queue, seen = [], deque(a.terms), set()
        while queue:  # names stand for the literals of their definition, each name once
            kind, start, end = queue.popleft()
            if kind != "name":
                parts.append((kind, start, end))
                continue
            short = text[start:end].rpartition(".")[2]
            if short in constants and short not in seen and short != a.name.rpartition(".")[2]:
                seen.add(short)
                queue.extendleft(reversed(constants[short]))
            elif len(a.terms) == 1 and short not in constants:
                parts.append((kind, start, end))  # a bare configuration value
        judged.append((a.name, weight, tuple(parts)))
        if len(parts) == 1 and parts[0][0] == "bare":
            tails.setdefault(parts[0][2], set()).add(parts[0][1])
    bare = {end: _tail_weights(text, list(starts), end) for end, starts in tails.items()}
    known: dict[tuple, float] = {}  # a constant's literals are judged once, not at each use
    out: dict[tuple[int, int], Finding] = {}
    for name, weight, parts in judged:
        if len(parts) == 1 and parts[0][0] == "bare":
            looks = bare[parts[0][2]][parts[0][1]]
        else:
            phrase = any(w.lower() in PHRASE_NAMES for w in _PARTS.findall(name))
            if (parts, phrase) not in known:
                known[parts, phrase] = literal_weight("".join(text[start:end] for _, start, end in parts), phrase)
            looks = known[parts, phrase]
        score = weight * looks
        if score >= THRESHOLD:
            for _, start, end in parts:
                if (start, end) not in out or out[start, end].score < score:
                    out[start, end] = Finding("literal", start, end, name, round(score, 6))
    return list(out.values())


def findings(text: str | None) -> list[Finding]:
    """All findings by start, then kind as listed."""
    if not text:
        return []
    both = base_findings(text) + (literal_findings(text) if "=" in text or ":" in text else [])
    return sorted(both, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


def spans_text(found: list[Finding]) -> str:
    return ",".join(f"{f.kind}:{f.start}:{f.end}" for f in found)


_SCHEMA = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [findings(t.as_py()) for t in batch.column("text")]
        base = [[f for f in x if f.kind != "literal"] for x in found]
        yield pa.record_batch([batch.column("id"), pa.array([[f._asdict() for f in x] for x in found], _SCHEMA), pa.array([spans_text(x) for x in found], pa.string()),
                               pa.array([hashlib.sha256(spans_text(x).encode()).hexdigest() for x in base], pa.string())], ["id", "findings", "spans", "base_sha256"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, findings (kind, start, end, name, score), spans, base_sha256, n_assign, n_access, n_hex, n_literal."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = base.mapInArrow(_scan, f"id {dict(base.dtypes)['id']}, findings array<struct<kind:string,start:long,end:long,name:string,score:double>>, spans string, base_sha256 string")
    counts = [F.expr(f"cast(size(filter(findings, f -> f.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return out.select(F.col("id").alias(id_col), "findings", "spans", "base_sha256", *counts)
