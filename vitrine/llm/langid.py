"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled running text is compiled into a
suffix automaton.  A text to judge is parsed greedily: the longest match that
occurs anywhere in the language's text is one phrase, and an unknown character
is a phrase by itself.  Few, long phrases mean a near language: the one with the
least normalised phrase count (phrases times the bits of a position in the
language's text, per character) wins.  Texts are lower-cased words with one space
between them; phrases cross words, so order and context count.  A word is letters
(Unicode L*) and the marks on them; numbers of any kind are no letters.

Parsing is sequential in a text, so the texts of a block are parsed side by side:
one step reads the next character of every text and looks up the transitions of
all texts and languages at once, in one table of (language, state) x character.
The longest texts come first, so those that have ended fall off the
end of the arrays; when few are left, they are finished one by one.  A worker holds
the table only, and of a batch the texts of one block at a time.

Bounds (parameters): sampled rows per language, characters of the window (placed
by a hash of the id) that is read of a sampled row, characters in an automaton,
shared out evenly among the language's windows.  Only the sample is bounded: every
label is learned and every text is judged whole.  Judging is a map without a
shuffle.

Defined results: null text or a text without a letter is `und` with score 0, and
so is every text where nothing could be learned; ties go to the smaller
language name; null ids neither teach nor are held out; repeated rows repeat
their result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.shipping import ship_package, worker_held
from vitrine.operators.lookup import size_checked
from vitrine.session import ensure_checkpoint_dir

UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
#: the same for texts below U+0300 but for general punctuation, by the faster library
OTHER, LATIN = re.compile("[\u0300-\u1fff\u2070-\U0010ffff]"), re.compile(r"[^\W\d_²³¹¼½¾]+")
PIECE = regex.compile(r"[\p{L}\p{M}]*+")
#: bounds of the labelled sample: rows of a language, characters of a row, characters in an automaton
SAMPLE_ROWS, SAMPLE_CHARS, AUTOMATON_CHARS = 400, 2_000, 100_000
#: characters of a block of texts, and parses (texts x languages) below which texts are finished one by one
BLOCK_CHARS, FEW = 4 << 20, 32
#: cells up to which the transition table is an array (4 bytes a cell), beyond it is hashed
DENSE = 1 << 25


class SuffixAutomaton:
    """All substrings of a text; `steps` maps state << 21 | character to the next state."""

    def __init__(self, text: str):
        link, length, out = [-1], [0], [{}]
        last = 0
        for c in map(ord, text):
            now = len(length)
            length.append(length[last] + 1)
            link.append(0)
            out.append({})
            p = last
            while p >= 0 and c not in out[p]:
                out[p][c] = now
                p = link[p]
            if p >= 0:
                q = out[p][c]
                if length[q] == length[p] + 1:
                    link[now] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    out.append(dict(out[q]))
                    while p >= 0 and out[p].get(c) == q:
                        out[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now
        self.steps = {state << 21 | c: to for state, edges in enumerate(out) for c, to in edges.items()}


def phrases(steps: dict[int, int], text: str, state: int = 0) -> int:
    """Number of longest matches that spell the text, the first one begun in `state`."""
    get, n = steps.get, 0
    for c in map(ord, text):
        to = get(state << 21 | c)
        if to is None:
            if state:
                n += 1
            to = get(c)
            if to is None:
                n += 1
                to = 0
        state = to
    return n + (1 if state else 0)


def running(text: str) -> str:
    """Lower-cased words with one space between them and at both ends; empty without a word."""
    text = text.lower()
    words = (LETTERS if OTHER.search(text) else LATIN).findall(text)
    return f" {' '.join(words)} " if words else ""


def language_text(samples: list[str]) -> str:
    """Running text of all samples, one to a line; the automaton's characters are shared out evenly."""
    texts = sorted(filter(None, map(running, samples)), key=lambda t: (len(t), t))
    out, left = [], AUTOMATON_CHARS
    for k, t in enumerate(texts):
        share = left // (len(texts) - k)
        if len(t) + 1 > share:
            t = t[: t.rfind(" ", 0, max(share - 1, 0)) + 1]  # whole words
        if len(t) > 1:
            out.append(t)
            left -= len(t) + 1
    return "\n".join(out)


class Edges:
    """Hash table of edges: key to the next state's row, 0 where there is none (no edge leads to row 0, a root)."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.to[slot[put]] = keys[put], to[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def one(self, key: int) -> int:
        """`take` of one key."""
        slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        keys = memoryview(self.keys)
        while (found := keys[slot]) != key:
            if found < 0:
                return 0
            slot = (slot + 1) & self.mask
        return int(self.to[slot])

    def take(self, keys: np.ndarray) -> np.ndarray:
        flat = keys.ravel()
        slot = self._slot(flat)
        found, to = self.keys[slot], self.to[slot]
        other = found != flat
        to[other] = 0
        left = np.flatnonzero(other & (found >= 0))
        while len(left):
            at = slot[left] = (slot[left] + 1) & self.mask
            found = self.keys[at]
            hit = found == flat[left]
            to[left[hit]] = self.to[at[hit]]
            left = left[~hit & (found >= 0)]
        return to.reshape(keys.shape)


class Steps:
    """One language's transitions as `SuffixAutomaton.steps` names them, read from the table of all."""

    def __init__(self, edges: np.ndarray | Edges, root: int, width: int, columns: dict[int, int]):
        self.cell = memoryview(edges).__getitem__ if isinstance(edges, np.ndarray) else edges.one
        self.root, self.width, self.columns = int(root), width, columns

    def get(self, key: int) -> int | None:
        column = self.columns.get(key & 0x1FFFFF)
        if column is None:
            return None
        to = self.cell(((key >> 21) + self.root) * self.width + column)
        return to - self.root if to else None


class Languages:
    """Automata of several languages; their states are the rows of one transition table, their characters its columns (0: not known)."""

    def __init__(self, texts: dict[str, str], dense: int = DENSE):
        self.names = sorted(texts)
        self.automata: list[Steps] = []
        self.bits = np.array([math.log2(len(texts[n]) + 1) for n in self.names])
        if not self.names:
            return
        edges, to = [], []
        for n in self.names:
            steps = SuffixAutomaton(texts[n]).steps
            edges.append(np.fromiter(steps.keys(), np.int64, len(steps)))
            to.append(np.fromiter(steps.values(), np.int64, len(steps)))
            del steps  # Python objects of one language at a time
        self.known = np.unique(np.concatenate(edges) & 0x1FFFFF)
        self.width = len(self.known) + 1
        rows = np.array([0] + [int(x.max()) + 1 for x in to])
        self.roots = np.cumsum(rows)[:-1]
        keys = np.concatenate([((e >> 21) + r) * self.width + np.searchsorted(self.known, e & 0x1FFFFF) + 1 for e, r in zip(edges, self.roots)])
        to = np.concatenate([t + r for t, r in zip(to, self.roots)])
        if int(rows.sum()) * self.width <= dense:
            self.edges = np.zeros(int(rows.sum()) * self.width, np.int32)
            self.edges[keys] = to
        else:  # scripts of many characters
            self.edges = Edges(keys, to)
        columns = {c: k + 1 for k, c in enumerate(self.known.tolist())}
        self.automata = [Steps(self.edges, root, self.width, columns) for root in self.roots]
        # where a phrase that begins with a character stands, and whether that character is a phrase by itself
        begun = self.edges.take(self.roots * self.width + np.arange(self.width)[:, None])
        self.alone = begun == 0
        self.begun = np.where(self.alone, self.roots, begun)

    def _columns(self, text: str, piece: int = 1 << 16) -> np.ndarray:
        """Column of every character; a piece at a time."""
        out = np.empty(len(text), np.int32)
        for at in range(0, len(text), piece):
            chars = np.frombuffer(text[at: at + piece].encode("utf-32-le"), "<i4")
            column = np.searchsorted(self.known, chars)
            out[at: at + piece] = np.where(self.known[np.minimum(column, len(self.known) - 1)] == chars, column + 1, 0)
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """Phrases of every text in every language, texts x languages; the longest text comes first."""
        n, languages = len(texts), len(self.automata)
        size = np.array([len(t) for t in texts])
        place = self._columns("".join(texts))
        at = np.cumsum(size) - size
        state, count = np.tile(self.roots, (n, 1)), np.zeros((n, languages), np.int64)
        ended = np.searchsorted(-size, -np.arange(size[0] + 1), "left")  # texts longer than t
        for t in range(int(size[0])):
            a = int(ended[t])
            if a * languages < FEW:
                for row in range(a):
                    for k, steps in enumerate(self.automata):
                        own = int(state[row, k] - self.roots[k])
                        count[row, k] += phrases(steps, texts[row][t:], own)  # its last phrase included
                        state[row, k] = self.roots[k]
                break
            c, was = place[at[:a]], state[:a]
            at += 1
            to = self.edges.take(was * self.width + c[:, None])
            stop = to == 0
            count[:a] += stop & (was != self.roots)
            count[:a] += stop & self.alone[c]
            state[:a] = np.where(stop, self.begun[c], to)
        return count + (state != self.roots)

    def judge(self, text: str | None) -> tuple[str, float]:
        return self.judge_all([text])[0]

    def judge_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of every text."""
        spelled = [running(t) if t else "" for t in texts]
        out = [(UNKNOWN, 0.0)] * len(texts)
        todo = sorted((k for k, t in enumerate(spelled) if t and self.names), key=lambda k: -len(spelled[k]))
        while todo:
            held = 0
            for taken, k in enumerate(todo):
                held += len(spelled[k])
                if held > BLOCK_CHARS and taken:
                    break
            else:
                taken = len(todo)
            block, todo = todo[:taken], todo[taken:]
            cost = self.counts([spelled[k] for k in block]) * self.bits
            best = np.argmin(cost, axis=1)
            least = cost[np.arange(len(block)), best]
            cost[np.arange(len(block)), best] = np.inf
            second = cost.min(axis=1)
            for k, b, x, y in zip(block, best.tolist(), least.tolist(), second.tolist()):
                out[k] = (self.names[b], 1.0 - x / y)  # alone: 1
        return out


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Language -> text of its automaton, from a bounded sample of the labelled rows.

    The sample takes rows by a hash of the id, at a rate set by each language's
    count: one narrow aggregate, then one filtered scan.  Of a row it reads a
    window whose place is another hash of the id.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "id is not null and text is not null and lang is not null")
    rates = rows.groupBy("lang").agg(F.least(F.lit(1.0), 1.5 * SAMPLE_ROWS / F.count(F.lit(1))).alias("rate")).checkpoint()
    share = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    room = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0))
    chosen = (rows.withColumn("u", share).join(size_checked(rates), "lang").where("u < rate")
              .withColumn("at", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("window")), (room + 1).cast("long")).cast("int"))
              .select("lang", "u", "id", F.expr(f"substring(text, at + 1, {SAMPLE_CHARS})").alias("text"), (F.col("at") > 0).alias("cut_before"), (F.col("at") < room).alias("cut_after")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", "id", "text"))
    samples: dict[str, list[str]] = {}
    for r in chosen.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).orderBy("lang", "place").collect():
        samples.setdefault(r.lang, []).append(_whole_words(r.text, r.cut_before, r.cut_after))
    return {lang: t for lang, texts in samples.items() if (t := language_text(texts))}


def _whole_words(text: str, cut_before: bool, cut_after: bool) -> str:
    """A window of a text without the pieces of words at its cuts (all of it where it is one piece)."""
    a = PIECE.match(text).end() if cut_before else 0
    b = len(text) - (PIECE.match(text[::-1]).end() if cut_after else 0)
    return text[a:b] if a < b else text


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have BLOCK_CHARS bytes at most together, or one longer text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK_CHARS, "right")))
        yield at, to
        at = to


def _worker_languages(texts: dict[str, str]) -> Languages:
    return worker_held("languages " + hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest(), lambda: Languages(texts))


def predict(docs: DataFrame, texts: dict[str, str], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row (the columns `carry` of docs, by default all), lang_pred, score."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(texts)  # at most AUTOMATON_CHARS characters for each label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = _worker_languages(shared.value)
        for batch in batches:
            rows = batch.column("row")
            texts = batch.column("text") if own else rows.field(place)
            for a, b in _slices(texts):
                found = languages.judge_all(texts[a:b].to_pylist())
                yield pa.record_batch([rows[a:b], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                                      ["row", "lang_pred", "score"])

    names = list(carry or docs.columns)
    own, place = text_col not in names, names.index(text_col) if text_col in names else -1  # a text that comes back is sent once
    base = docs.select(F.struct(*names).alias("row"), *[F.col(text_col).alias("text")] * own)
    return base.mapInArrow(run, f"row {dict(base.dtypes)['row']}, lang_pred string, score double")


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score; learns from the rows that are not held out."""
    out = held_out(F.col(id_col))
    texts = learn(docs.where(~out), id_col, text_col, lang_col)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the text need not come back from the workers
    return predict(slim, texts, carry=["id"]).select(F.col("row.id").alias(id_col), held_out(F.col("row.id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that have a language, which is written into `lang_col`; `und` goes."""
    texts = learn(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    found = predict(docs, texts, text_col).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.col("lang_pred").alias(c) if c == lang_col else F.col(f"row.{c}") for c in docs.columns])
