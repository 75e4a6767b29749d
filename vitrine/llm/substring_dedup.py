"""Substring dedup with repeated-phrase automata.

A window is `window` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller id.

1. Confirm recurring phrases.  Every window is named by the least of its phrases
   of a fifth of its length (64-bit hashes): equal windows have equal names, and
   a document has few names, about two for each window's length.  Names are counted by partial aggregates; one
   that two documents share is recurring and belongs to the shard of its
   smallest document.
2. Route.  A document goes, once, to each shard that holds one of its recurring
   names.  Shards are sized by their words; one that a frequent passage makes
   too large is cut into parts by a hash of the document.
3. Passages.  A map over the routed documents gives their windows with recurring
   names; partial aggregates by window confirm those that two documents share.
   Runs of them, cut into pieces that overlap by a window, are passages, text of
   their first document.  A shard's passages are dealt into blocks by their own
   hash, so that a task holds one part of the documents and one block.
4. Locate.  A block of passages, compiled into Aho-Corasick automata (one
   letter per distinct word; patterns are the aligned half windows, one of which
   lies in any window), streams over every document of every part of the shard.
   Each hit is extended by half a window to the left and right by comparing
   words, so what is removed is proved on the words, not on hashes.  Spans of a
   document's shards and blocks are united.

Defined results: null text has no words; null ids neither remove nor lose words;
rows that share an id are not each other's source; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.shipping import ship_package
from vitrine.llm.textwords import blocks, gram_hashes
from vitrine.session import ensure_checkpoint_dir

_COVERED = re.compile(rb"\x01+")
#: words of a part of a shard, of the passages in one automaton (and block), and of a passage's piece
PART_WORDS, AUTOMATON_WORDS, PIECE_WORDS = 1_000_000, 800_000, 20_000
SPANS = "array<struct<start:int,end:int>>"


def window_names(words: np.ndarray, window: int) -> np.ndarray:
    """For every window the least hash of its phrases of a fifth of the window's length."""
    phrase = max(1, window // 5)
    low = gram_hashes(words, phrase)
    reach, need = 1, window - phrase + 1
    if len(low) < need:
        return np.empty(0, np.uint64)
    while 2 * reach <= need:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = need - reach
    return np.minimum(low[: len(low) - rest], low[rest:])


def _distinct(names: np.ndarray) -> np.ndarray:
    if not len(names):
        return names
    change = np.ones(len(names), bool)
    change[1:] = names[1:] != names[:-1]
    return np.unique(names[change])


def _profiles(window: int):
    """Texts -> words, digest of all words, window names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, shas, offsets, names = [], [], [0], []
            for a, b, block in blocks(batch.column("text"), lower=False):
                hashes = block.word_hashes()
                for k in range(b - a):
                    own = hashes[block.first[k]: block.first[k + 1]]
                    n_words.append(len(own))
                    shas.append(hashlib.sha256(b" ".join(block.text_words(k))).hexdigest())
                    found = _distinct(window_names(own, window))
                    names.append(found.view(np.int64))
                    offsets.append(offsets[-1] + len(found))
            flat = pa.array(np.concatenate(names) if names else np.empty(0, np.int64))
            yield pa.record_batch([batch.column("id"), batch.column("row"), pa.array(n_words, pa.int64()), pa.array(shas, pa.string()),
                                   pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], ["id", "row", "n_words", "sha", "names"])

    return run


def _shared_windows(window: int):
    """(id, row, text, to: shards and the names there) -> the windows with a recurring name, each once for a document and shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, row = batch.column("to").to_pylist(), 0
            for a, b, block in blocks(batch.column("text"), lower=False):
                words = block.word_hashes()
                hashes, shards, owner, at = [], [], [], []
                for k in range(b - a):
                    own = words[block.first[k]: block.first[k + 1]]
                    found, every = window_names(own, window), gram_hashes(own, window)
                    for to in names[row + k]:
                        which = np.flatnonzero(np.isin(found, np.array(to["names"], np.int64).view(np.uint64)))
                        values, first = np.unique(every[which], return_index=True)
                        hashes.append(values)
                        shards.append(np.full(len(values), to["shard"], np.int32))
                        owner.append(np.full(len(values), row + k))
                        at.append(which[first])
                row += b - a
                if hashes:
                    doc = pa.array(np.concatenate(owner))
                    yield pa.record_batch([pa.array(np.concatenate(shards)), pa.array(np.concatenate(hashes).view(np.int64)), batch.column("id").take(doc),
                                           batch.column("row").take(doc), pa.array(np.concatenate(at).astype(np.int32))], ["shard", "hash", "id", "row", "pos"])

    return run


def _runs(positions: np.ndarray, words: list[bytes], window: int) -> Iterator[list[bytes]]:
    """Passages that the windows at these (ascending) positions cover, one for each run of neighbours, in pieces that overlap by a window."""
    cut = np.flatnonzero(positions[1:] != positions[:-1] + 1) + 1
    for run in np.split(positions, cut):
        for k in range(0, len(run), PIECE_WORDS):
            piece = run[k: k + PIECE_WORDS]
            yield words[piece[0]: piece[-1] + window]


def _cut_passages(window: int):
    """(shard, id, text, positions of recurring windows) -> passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"shard": [], "source": [], "passage": []}
            for shard, source, text, at in zip(*(batch.column(c).to_pylist() for c in ("shard", "id", "text", "positions"))):
                found = list(_runs(np.sort(np.array(at, np.int64)), text.encode().split(), window))
                out["passage"] += [b" ".join(words).decode() for words in found]
                out["shard"] += [shard] * len(found)
                out["source"] += [source] * len(found)
            yield pa.record_batch([pa.array(out["shard"], pa.int32()), pa.array(out["source"], batch.schema.field("id").type), pa.array(out["passage"], pa.string())], list(out))

    return run


class PhraseAutomaton:
    """Passages as strings of one letter per distinct word, and an automaton over their aligned half windows.

    A half window carries its neighbourhoods (half a window to either side), each
    with the smallest document that has it: any window around the hit lies inside.
    """

    OTHER = "\U0010ffff"

    def __init__(self, passages: list[tuple[object, list[bytes]]], window: int):
        import ahocorasick

        self.window = window
        self.half = half = window // 2
        self.reach = window - half
        self.letters: dict[bytes, str] = {}
        found: dict[str, dict[tuple[str, str], object]] = {}
        for source, words in passages:
            text = "".join([self._letter(w) for w in words])
            for i in range(0, len(text) - half + 1, half):
                around = found.setdefault(text[i: i + half], {})
                sides = (text[max(0, i - self.reach): i], text[i + half: i + half + self.reach])
                if sides not in around or source < around[sides]:
                    around[sides] = source
        self.automaton = ahocorasick.Automaton()
        for phrase, around in found.items():
            self.automaton.add_word(phrase, sorted(((s, left, right) for (left, right), s in around.items()), key=lambda x: x[0]))
        self.automaton.make_automaton()

    def _letter(self, word: bytes) -> str:
        have = self.letters.get(word)
        if have is None:
            n = len(self.letters) + 1
            have = self.letters[word] = chr(n if n < 0xD800 else n + 0x800)  # no surrogates
        return have

    def cover(self, words: list[bytes], smaller_than, covered: bytearray) -> None:
        """Marks the words of runs of at least a window that a passage from a smaller id holds."""
        get, other = self.letters.get, self.OTHER
        text = "".join([get(w, other) for w in words])
        for end, around in self.automaton.iter(text):
            start, end = end - self.half + 1, end + 1
            low, high = max(0, start - self.reach), min(len(text), end + self.reach)
            before, after = text[low:start], text[end:high]
            for source, left, right in around:
                if not source < smaller_than or covered.find(0, low, high) < 0:
                    break
                a, b = _suffix(before, left), _prefix(after, right)
                if a + self.half + b >= self.window:
                    covered[start - a: end + b] = b"\1" * (a + self.half + b)


def _prefix(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


def _suffix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if not n or a[-n:] == b[-n:]:
        return n
    return next(k for k in range(n) if a[-1 - k] != b[-1 - k])


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _removed(docs: pa.Table, texts: list[list[bytes]], passages: Iterable[tuple[object, list[bytes]]], window: int) -> pa.Table:
    """Streams the documents through automata over the passages, so many words at a time."""
    ids = docs.column("id").to_pylist()
    covered = [bytearray(len(t)) for t in texts]
    held, size = [], 0

    def stream():
        if held:
            automaton = PhraseAutomaton(held, window)
            for words, own, cover in zip(texts, ids, covered):
                automaton.cover(words, own, cover)

    for source, words in passages:
        if size + len(words) > AUTOMATON_WORDS:
            stream()
            held, size = [], 0
        held.append((source, words))
        size += len(words)
    stream()
    keep = [k for k, c in enumerate(covered) if 1 in c]
    spans = [[{"start": m.start(), "end": m.end()} for m in _COVERED.finditer(covered[k])] for k in keep]
    which = pa.array(keep, pa.int64())
    return pa.table({"id": docs.column("id").take(which), "row": docs.column("row").take(which),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))})


def _locate(window: int):
    """Documents of a part, and a block of its shard's passages -> removed spans."""
    def run(docs: pa.Table, passages: pa.Table) -> pa.Table:
        texts = [t.as_py().encode().split() for t in docs.column("text")]
        found = ((s.as_py(), p.as_py().encode().split()) for s, p in zip(passages.column("source"), passages.column("passage")))
        return _removed(docs, texts, found, window)

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, row, text, spans of several shards) -> spans united, digest of what is left."""
    for batch in batches:
        out, shas, removed = [], [], []
        for text, several in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.encode().split()
            cut = union([(s["start"], s["end"]) for spans in several for s in spans])
            kept, at = [], 0
            for a, b in cut:
                kept += words[at:a]
                at = b
            kept += words[at:]
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            removed.append(len(words) - len(kept))
            out.append([{"start": a, "end": b} for a, b in cut])
        yield pa.record_batch([batch.column("id"), batch.column("row"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()),
                               pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["id", "row", "n_removed", "sha", "spans"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per row of docs: id, text_hash, n_words, n_removed, kept_sha256, spans (removed words, [start, end) by word)."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/substring-dedup-{uuid.uuid4().hex}"
    ship_package(spark)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    kind = dict(base.dtypes)["id"]
    # words, digest and names of every document: read by three steps
    base.mapInArrow(_profiles(window), f"id {kind}, row long, n_words long, sha string, names array<long>").write.parquet(f"{folder}/profile")
    profile = spark.read.parquet(f"{folder}/profile")
    named = profile.where("id is not null").select("id", F.explode("names").alias("name"))
    recurring = named.groupBy("name").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("name", "low")
    met = named.join(recurring, "name").select("id", "name", "low").checkpoint()
    words = profile.join(met.select("id").distinct(), "id", "left_semi").agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = 1 + int(words) // (PART_WORDS // 2)
    routes = (met.withColumn("shard", F.pmod(F.xxhash64("low"), F.lit(shards)).cast("int")).groupBy("id", "shard").agg(F.collect_list("name").alias("names")).checkpoint())
    sized = profile.where("id is not null").groupBy("id").agg(F.sum("n_words").alias("n_words"))
    parts = routes.select("id", "shard").join(sized, "id").groupBy("shard").agg(F.ceil(F.sum("n_words") / PART_WORDS).cast("int").alias("parts")).checkpoint()
    routes = routes.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))

    # one row for rows of one id and text
    (base.join(routes.groupBy("id").agg(F.collect_list(F.struct("shard", "part", "names")).alias("to")), "id")
     .dropDuplicates(["id", "row"]).write.parquet(f"{folder}/routed"))
    routed = spark.read.parquet(f"{folder}/routed")
    windows = (routed.mapInArrow(_shared_windows(window), f"shard int, hash long, id {kind}, row long, pos int")
               .groupBy("shard", "hash").agg(F.min(F.struct("id", "row", "pos")).alias("first"), F.max("id").alias("last"))
               .where("first.id <> last").groupBy("shard", "first.id", "first.row").agg(F.collect_list("first.pos").alias("positions")))
    (windows.join(routed.select("id", "row", "text"), ["id", "row"]).select("shard", "id", "text", "positions")
     .mapInArrow(_cut_passages(window), f"shard int, source {kind}, passage string").groupBy("shard", "passage").agg(F.min("source").alias("source"))
     .write.parquet(f"{folder}/passages"))
    passages = spark.read.parquet(f"{folder}/passages")
    sizes = passages.groupBy("shard").agg(F.ceil(F.sum(F.length("passage") - F.length(F.replace("passage", F.lit(" "))) + 1) / AUTOMATON_WORDS).cast("int").alias("blocks"))
    layout = parts.join(sizes, "shard").checkpoint()
    # every part of a shard meets every block of its passages
    dealt = (passages.join(layout, "shard").withColumn("block", F.pmod(F.xxhash64("passage"), "blocks").cast("int"))
             .select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "source", "passage"))
    placed = (routed.select("id", "row", "text", F.explode("to").alias("t")).select(F.col("t.shard").alias("shard"), F.col("t.part").alias("part"), "id", "row", "text")
              .join(layout, "shard").select("shard", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "row", "text"))
    keys = ("shard", "part", "block")
    located = placed.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_locate(window), f"id {kind}, row long, spans {SPANS}")
    spans = located.groupBy("id", "row").agg(F.collect_list("spans").alias("spans"))
    cut = (routed.select("id", "row", "text").join(spans, ["id", "row"])
           .mapInArrow(_kept, f"id {kind}, row long, n_removed long, sha string, spans {SPANS}").withColumnRenamed("sha", "kept_sha"))
    return (profile.join(cut, ["id", "row"], "left")
            .select(F.col("id").alias(id_col), F.col("row").alias("text_hash"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256"), F.coalesce("spans", F.array().cast(SPANS)).alias("spans")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """docs with the words of repeated windows taken out of the text; untouched texts stay as they are."""
    cut = (repeated_spans(docs, id_col, text_col, window).where("n_removed > 0").select(F.col(id_col).alias("__id"), "text_hash", "spans")
           .withColumnRenamed("text_hash", "__hash").withColumnRenamed("spans", "__spans").dropDuplicates(["__id", "__hash"]))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    kept = F.filter(F.transform(words, lambda w, i: F.when(~F.exists("__spans", lambda s: (s["start"] <= i) & (i < s["end"])), w)), lambda w: w.isNotNull())
    joined = docs.join(cut, (F.col(id_col) == F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__hash")), "left")
    return joined.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.array_join(kept, " "))).select(*docs.columns)
