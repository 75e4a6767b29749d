"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition.

A text is split by the tokenizer's pattern, every match is encoded on its own.
Matches that a worker hasn't met yet become token-position rows (word,
position, token); a recursive query joins neighbouring tokens with the merge
table and contracts each word's leftmost pair of least rank, until no word has a
pair left.  A match that is itself a token is that token, as in the rank-file
format's library.  Matches longer than LONG bytes are contracted in a table that
is replaced step by step, so that its rows don't add up, and the occurrences of
the least pair go together: from the left up to the first whose merged token
makes a pair of lesser rank with a neighbour, which is the order one by one.
Decoding joins token positions with the vocabulary and aggregates the bytes in
order.

Tokenising is a map over partitions: no shuffle.  The rank file (a megabyte)
is read on the driver and broadcast; memory in a worker is bounded by BLOCK and
CACHE.  Defined results: null text is the empty text (no tokens); repeated rows
repeat their result; an id that the vocabulary lacks is an error in decoding.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.shipping import ship_package, worker_held

#: characters encoded together, words kept by a worker, words per recursive query, bytes of a long word, tokens decoded together
BLOCK, CACHE, QUERY_WORDS, LONG, DECODE = 1 << 20, 400_000, 16_000, 64, 1 << 18

CONTRACT = """
with recursive steps(step, word, pos, token, next, next_pos) as (
    select 0, word, pos, token, lead(token) over places, lead(pos) over places
    from start window places as (partition by word order by pos)
  union all (
    with least as (select word, min((rank::bigint << 32) | pos) as best from steps join merges on token = l and next = r group by word),
         pair as (select s.word, s.pos, s.next_pos, (best >> 32)::int as merged
                  from least join steps s on s.word = least.word and s.pos = (best & 4294967295)),
         after_pair as (select s.word, s.next, s.next_pos from steps s join pair on s.word = pair.word and s.pos = pair.next_pos)
    select s.step + 1, s.word, s.pos,
           case when s.pos = pair.pos then merged else s.token end,
           case when s.pos = pair.pos then after_pair.next when s.next_pos = pair.pos then merged else s.next end,
           case when s.pos = pair.pos then after_pair.next_pos else s.next_pos end
    from steps s join pair on s.word = pair.word join after_pair on after_pair.word = s.word
    where s.pos <> pair.next_pos))
select word, list(token order by pos) as ids
from steps join (select word, max(step) as step from steps group by word) using (word, step) group by word order by word
"""

LEAST_PAIRS = """
create or replace temp table hits as
with pairs as (select word, pos, token, lead(token) over w as next, lead(pos) over w as next_pos, lag(token) over w as before,
                      lead(token, 2) over w as after, lead(pos, 2) over w as after_pos
               from long_words window w as (partition by word order by pos)),
     ranked as (select pairs.*, rank from pairs join merges on token = l and next = r),
     least as (select * from ranked join (select word, min(rank) as rank from ranked group by word) using (word, rank)),
     linked as (select *, coalesce(lag(next_pos) over (partition by word order by pos) = pos, false) as chained from least),
     runs as (select *, sum(case when chained then 0 else 1 end) over (partition by word order by pos) as run from linked),
     chosen as (select * from (select *, row_number() over (partition by word, run order by pos) as k from runs) where k % 2 = 1),
     beside as (select *, case when lag(after_pos) over (partition by word order by pos) = pos then rank else before end as left_now from chosen),
     turned as (select b.*, (x.rank is not null or y.rank is not null)::int as turns
                from beside b left join merges x on x.l = left_now and x.r = b.rank and x.rank < b.rank
                              left join merges y on y.l = b.rank and y.r = after and y.rank < b.rank)
select word, pos, next_pos, rank
from (select *, sum(turns) over (partition by word order by pos rows between unbounded preceding and 1 preceding) as turns_before from turned)
where coalesce(turns_before, 0) = 0
"""

CONTRACT_ALL = """
create or replace temp table long_words as
select s.word, s.pos, coalesce(h.rank, s.token) as token
from long_words s left join hits h on s.word = h.word and s.pos = h.pos
where (s.word, s.pos) not in (select word, next_pos from hits)
"""

ORDERED_DECODE = """
select doc, unhex(string_agg(hex, '' order by pos)) as bytes from positions join vocabulary using (token) group by doc order by doc
"""


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Lines of base64 bytes and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


class BytePairs:
    """Merge table and vocabulary of a rank file in an in-memory DuckDB; encodes words and decodes ids."""

    def __init__(self, lines: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(lines)
        self.split = regex.compile(pattern).findall
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "400MB"})
        self.known: dict[str, bytes] = {}
        self.tables: set[str] = set()

    def _merge_table(self) -> None:
        """Pairs of tokens whose bytes together are a token; made where a worker encodes."""
        if "merges" in self.tables:
            return
        ranks = self.ranks
        merges = [(l, r, m) for token, m in ranks.items() for i in range(1, len(token))
                  if (l := ranks.get(token[:i])) is not None and (r := ranks.get(token[i:])) is not None]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._table("merges", dict(zip("l r rank".split(), (pa.array(x, pa.int32()) for x in zip(*merges)))))
        self.tables.add("merges")

    def _vocabulary_table(self) -> None:
        """Token and its bytes; made where a worker decodes."""
        if "vocabulary" not in self.tables:
            self._table("vocabulary", {"token": pa.array(list(self.ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks])})
            self.tables.add("vocabulary")

    def _table(self, name: str, columns: dict) -> None:
        rows = pa.table(columns)
        self.db.register("arrow_rows", rows)
        self.db.sql(f"create or replace temp table {name} as select * from arrow_rows")
        self.db.unregister("arrow_rows")

    def _start(self, name: str, words: list[bytes]) -> None:
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self._table(name, {"word": pa.array(word), "pos": pa.array(pos.astype(np.int32)), "token": pa.array(self.bytes[np.frombuffer(b"".join(words), np.uint8)])})

    def _ids(self, query: str) -> list[bytes]:
        ids = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
        offsets = (np.asarray(ids.offsets) * 4).tolist()
        raw = np.asarray(ids.values).astype("<u4").tobytes()
        return [raw[a:b] for a, b in zip(offsets, offsets[1:])]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32 bit) of non-empty words, by recursive contraction."""
        self._merge_table()
        out: list[bytes] = [b""] * len(words)
        one = [k for k, w in enumerate(words) if len(w) <= LONG]
        for at in range(0, len(one), QUERY_WORDS):
            part = one[at: at + QUERY_WORDS]
            self._start("start", [words[k] for k in part])
            for k, ids in zip(part, self._ids(CONTRACT), strict=True):
                out[k] = ids
        many = [k for k, w in enumerate(words) if len(w) > LONG]
        if many:
            self._start("long_words", [words[k] for k in many])
            while True:
                self.db.sql(LEAST_PAIRS)
                if not self.db.sql("select 1 from hits limit 1").fetchall():
                    break
                self.db.sql(CONTRACT_ALL)
            for k, ids in zip(many, self._ids("select word, list(token order by pos) as ids from long_words group by word order by word"), strict=True):
                out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.split(t) for t in texts]
        known, ranks = self.known, self.ranks
        if len(known) > CACHE:  # the older half goes
            for piece in list(islice(known, CACHE // 2)):
                del known[piece]
        new = list(dict.fromkeys(p for pieces in split for p in pieces if p not in known))
        raw = [p.encode() for p in new]
        merged = [k for k, w in enumerate(raw) if w not in ranks]
        known.update((p, ranks[w].to_bytes(4, "little")) for p, w in zip(new, raw) if w in ranks)
        known.update(zip([new[k] for k in merged], self.merge([raw[k] for k in merged])))
        return [b"".join([known[p] for p in pieces]) for pieces in split]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids."""
        self._vocabulary_table()
        counts = np.array([len(x) // 4 for x in ids])
        tokens = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        self._table("positions", {"doc": pa.array(doc), "pos": pa.array(np.arange(len(tokens), dtype=np.int32)), "token": pa.array(tokens)})
        if self.db.sql("select 1 from positions anti join vocabulary using (token) limit 1").fetchall():
            raise ValueError("an id is not in the vocabulary")
        rows = self.db.sql(ORDERED_DECODE).to_arrow_table()
        out = [b""] * len(ids)
        for k, b in zip(rows.column("doc").to_pylist(), rows.column("bytes").to_pylist()):
            out[k] = b
        return out


def worker_pairs(lines: bytes, pattern: str) -> BytePairs:
    """The worker's one instance for a rank file and pattern."""
    return worker_held("byte pairs " + hashlib.sha256(lines + pattern.encode()).hexdigest(), lambda: BytePairs(lines, pattern))


def _slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for k, n in enumerate(lengths):
        if k > at and total + n > most:
            yield at, k
            at, total = k, 0
        total += n
    if lengths:
        yield at, len(lengths)


def _vocabulary(df: DataFrame, path: str):
    ship_package(df.sparkSession)
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carry` and ids: the token ids of every text as little-endian unsigned 32-bit integers."""
    lines = _vocabulary(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = worker_pairs(lines.value, pattern)
        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices([t.as_buffer().size for t in texts], BLOCK):
                yield pa.record_batch([batch.column("row")[a:b], pa.array(pairs.encode(texts[a:b].to_pylist()), pa.binary())], ["row", "ids"])

    base = docs.select(F.struct(*carry).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.mapInArrow(run, f"row {dict(base.dtypes)['row']}, ids binary").select("row.*", "ids")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The columns of encoded and decoded: the bytes that the ids stand for."""
    lines = _vocabulary(encoded, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = worker_pairs(lines.value, pattern)
        for batch in batches:
            ids = batch.column("ids")
            for a, b in _slices([x.as_buffer().size // 4 for x in ids], DECODE):
                yield pa.record_batch([batch.column("row")[a:b], pa.array(pairs.decode(ids[a:b].to_pylist()), pa.binary())], ["row", "decoded"])

    base = encoded.select(F.struct(*encoded.columns).alias("row"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return base.mapInArrow(run, f"row {dict(base.dtypes)['row']}, decoded binary").select("row.*", "decoded")


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `carry`, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, and decoded from the ids, in one pass."""
    lines = _vocabulary(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = worker_pairs(lines.value, pattern)
        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices([t.as_buffer().size for t in texts], BLOCK):
                ids = pairs.encode(texts[a:b].to_pylist())
                decoded = [d for c, e in _slices([len(x) // 4 for x in ids], DECODE) for d in pairs.decode(ids[c:e])]
                yield pa.record_batch([batch.column("row")[a:b], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                                       pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())], ["row", "n_tokens", "ids_sha256", "decoded_sha256"])

    base = docs.select(F.struct(*carry).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (base.mapInArrow(run, f"row {dict(base.dtypes)['row']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .select("row.*", "n_tokens", "ids_sha256", "decoded_sha256"))
