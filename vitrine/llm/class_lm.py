"""Brown class-based n-gram scoring of texts.

p(w_i | w_{i-1}) = p(class_i | class_{i-1}) * p(w_i | class_i).

* Counts: documents are dealt into blocks of about BLOCK_BYTES by a hash of the
  id; every block numbers its distinct words and keeps its texts as numbers.  Words
  are dealt into buckets by a hash, about as many words in each as in a block; a
  bucket adds the training counts up over the corpus and keeps, for each block,
  which of its words the block has, in the block's order.  Blocks and buckets
  then exchange one row for each two of them, with arrays in that order and
  without words or keys.  No vocabulary is ever broadcast or collected.
* Classes: every training word has one of `classes` classes.  The `vocabulary`
  most frequent words only seed them, by exchange clustering on the driver.  Then
  exchange sweeps run over all words as jobs: each block counts its words'
  neighbours by class, the counts meet by bucket, and every word takes the class
  that raises the class-bigram likelihood most, all against one matrix of classes
  by classes.  Moves of a sweep are made together; a sweep that lowers the
  likelihood is taken back.  The end of a text is a class by itself, and a word
  that was never seen is in an open class.
* Probabilities: class transitions are interpolated with the class unigram,
  emissions are additive over the class's words; the open class keeps one share
  for a word that was never seen.

The base score is the additive unigram model of the same counts.  Everything that
is counted covers all training documents and grows with them.  Defined results:
null text is empty (one token: its end); rows with a null id are training rows;
without training rows every score is over an empty model (no token is known);
repeated rows repeat their result and count twice.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vitrine.llm.shipping import release_shuffles, ship_package
from vitrine.session import ensure_checkpoint_dir

#: bytes of text in a block
BLOCK_BYTES = 16 << 20
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def tokens(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words between 0x20 and 0x09-0x0D (what bytes.split takes as space)."""
    return (text or "").encode().translate(_LOWER).split()


def held_out(id_: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _packed(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes: the upper ones are mostly zeros and compress well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _encode(id_type: pa.DataType, buckets: int):
    """A block -> a row for each document (texts as places of words), then one for each bucket: places, words and their counts in training texts."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        codes, train = [], []
        for text, out in zip(table.column("text"), table.column("held_out").to_pylist()):
            words = tokens(text.as_py())
            at = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            codes.append(_packed(at))
            if not out:
                train.append(at)
        n, docs = len(number), len(codes)
        counts = np.bincount(np.concatenate(train), minlength=n) if train else np.zeros(n, np.int64)
        none = lambda k, kind: pa.nulls(k, kind)
        block, words = key[0].as_py(), list(number)
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, n) % buckets
        order = np.argsort(bucket, kind="stable")
        places = [x for x in np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets))) if len(x)]
        own = len(places)
        d = pa.table({"block": pa.array(np.full(docs, block, np.int32)), "id": table.column("id"), "held_out": table.column("held_out"), "codes": pa.array(codes, pa.binary()),
                      "bucket": none(docs, pa.int32()), "places": none(docs, pa.binary()), "words": none(docs, pa.binary()), "counts": none(docs, pa.binary())})
        w = pa.table({"block": pa.array(np.full(own, block, np.int32)), "id": none(own, id_type), "held_out": none(own, pa.bool_()), "codes": none(own, pa.binary()),
                      "bucket": pa.array([int(bucket[x[0]]) for x in places], pa.int32()), "places": pa.array([_packed(x) for x in places], pa.binary()),
                      "words": pa.array([b" ".join([words[k] for k in x.tolist()]) for x in places], pa.binary()),  # no word has a blank
                      "counts": pa.array([_packed(counts[x]) for x in places], pa.binary())})
        return pa.concat_tables([d.cast(w.schema), w])

    return run


def _count(vocabulary: int):
    """A bucket's words of all blocks -> for each block which of the bucket's words it has (at), one row (block -1) with all their counts, and
    rows (block -2) with the most frequent words."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        at, counts = [], []
        for words, n in zip(table.column("words"), table.column("counts")):
            words = words.as_py().split(b" ")
            at.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            counts.append(_unpacked(n.as_py()))
        total = np.zeros(len(number), np.int64)
        for x, n in zip(at, counts):
            total[x] += n  # a block has each word once
        top = heapq.nsmallest(vocabulary, ((-n, w, k) for (w, k), n in zip(number.items(), total.tolist()) if n))
        rest = len(top)
        return pa.table({"bucket": pa.array(np.full(len(at) + 1 + rest, key[0].as_py(), np.int32)), "block": pa.array([*table.column("block").to_pylist(), -1, *[-2] * rest], pa.int32()),
                         "at": pa.array([*map(_packed, at), *[None] * (1 + rest)], pa.binary()), "totals": pa.array([*[None] * len(at), total.tobytes(), *[None] * rest], pa.binary()),
                         "word": pa.array([*[None] * (len(at) + 1), *(w for _, w, _ in top)], pa.binary()),
                         "n": pa.array([*[None] * len(at), int(total.sum()), *(-n for n, _, _ in top)], pa.int64()),
                         "place": pa.array([*[None] * len(at), int((total > 0).sum()), *(k for *_, k in top)], pa.int32())})

    return run


def _placed(open_: int, counts: bool):
    """A bucket's rows for the blocks, and classes (at, class) of its words -> for each block the classes (and counts) of its words; others are open."""
    def run(posts: pa.Table, found: pa.Table) -> pa.Table:
        block = posts.column("block").to_numpy()
        total = np.frombuffer(posts.column("totals")[int(np.flatnonzero(block == -1)[0])].as_py(), np.int64)
        cls = np.full(len(total), open_)
        for at, c in zip(found.column("at"), found.column("class")):
            cls[_unpacked(at.as_py())] = _unpacked(c.as_py())
        rows = np.flatnonzero(block >= 0)
        at = [_unpacked(posts.column("at")[k].as_py()) for k in rows.tolist()]
        return pa.table({"block": pa.array(block[rows].astype(np.int32)), "bucket": pa.array(np.full(len(rows), posts.column("bucket")[0].as_py(), np.int32)),
                         "class": pa.array([_packed(cls[x]) for x in at], pa.binary()), "totals": pa.array([total[x].tobytes() if counts else None for x in at], pa.binary())})

    return run


def _met(rows: pa.Table, placed: pa.Table) -> tuple[list[bytes], list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows and what the buckets say of its words -> texts, (bucket, words in it), and in the buckets' order: places, classes, counts."""
    codes, parts = [], {}
    for c, bucket, places in zip(*(rows.column(x) for x in ("codes", "bucket", "places"))):
        if c.is_valid:
            codes.append(c.as_py())
        else:
            parts[bucket.as_py()] = _unpacked(places.as_py())
    of = dict(zip(placed.column("bucket").to_pylist(), zip(placed.column("class"), placed.column("totals"))))
    order = sorted(parts)
    join = lambda x: np.concatenate([np.empty(0, np.int64), *x])
    return (codes, [(b, len(parts[b])) for b in order], join(parts[b] for b in order), join(_unpacked(of[b][0].as_py()) for b in order),
            join(np.frombuffer(of[b][1].as_py(), np.int64) for b in order if of[b][1].is_valid))


def _neighbours(size: int, words: bool):
    """A block's training texts, and the classes of its words -> counts of neighbours by class.

    words: for each bucket, how many cells each word of the block in it has, and the
    cells: a code (the class on its right, size + the class on its left, 2 * size
    for the word itself) and its count; else the block's matrix of classes by
    classes.  The last class is the end, the one before it open.
    """
    def run(rows: pa.Table, placed: pa.Table) -> pa.Table:
        texts, buckets, places, cls, _ = _met(rows, placed)
        n = len(places)
        row = np.full(n + 1, n)  # the last one stands for the end
        row[places] = np.arange(n)
        cls = np.append(cls, size - 1)
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        matrix = np.zeros(size * size, np.int64)

        def added(held):
            code, back = np.unique(np.concatenate([codes, *(h for h in held)]), return_inverse=True)
            return code, np.bincount(back, np.concatenate([counts, np.ones(len(back) - len(counts), np.int64)])).astype(np.int64)

        held, waiting, width = [], 0, 2 * size + 1
        for raw in texts:
            at = np.concatenate([[n], _unpacked(raw), [n]])
            a, b = row[at[:-1]], row[at[1:]]
            if not words:
                code, k = np.unique(cls[a] * size + cls[b], return_counts=True)
                matrix[code] += k
                continue
            same = (a == b) & (a < n)
            right, left = (a < n) & ~same, (b < n) & ~same
            held += [a[right] * width + cls[b[right]], b[left] * width + size + cls[a[left]], a[same] * width + 2 * size]
            waiting += 2 * len(a)
            if waiting > 2_000_000:
                codes, counts = added(held)
                held, waiting = [], 0
        if not words:
            code = np.flatnonzero(matrix)
            return pa.table({"code": pa.array(code.astype(np.int32)), "n": pa.array(matrix[code])})
        codes, counts = added(held)
        out: dict[str, list] = {"bucket": [], "many": [], "code": [], "n": []}
        start = 0
        for bucket, k in buckets:
            a, b = np.searchsorted(codes, [start * width, (start + k) * width])
            many = np.bincount(codes[a:b] // width - start, minlength=k)
            for name, x in zip(out, (bucket, _packed(many), _packed(codes[a:b] % width), _packed(counts[a:b]))):
                out[name].append(x)
            start += k
        block = rows.column("block")[0].as_py() if rows.num_rows else 0
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "block": pa.array(np.full(len(buckets), block, np.int32))}
                        | {c: pa.array(out[c], pa.binary()) for c in ("many", "code", "n")})

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def move_gains(big: np.ndarray, cls: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(words, classes) likelihood gained by each word in each class, against its being left out.

    big: matrix of classes by classes, the last two (open, end) take no words; cls: the
    words' classes; (word, code, n): their neighbours as _neighbours counts them.
    """
    size, k, many = len(big), len(big) - 2, len(cls)
    side, other = code // size, code % size
    both = np.zeros((3, many, size))
    both[side, word, other] = n
    (right, left), own = both[:2], both[2, :, 0]
    inside = cls < k  # words that have a class to be taken out of
    at, w = cls[inside], np.flatnonzero(inside)
    gain = np.zeros((many, k))
    for mine, theirs, table in ((right, left, big), (left, right, big.T)):
        i, d = np.nonzero(mine)
        for start in range(0, len(i), 20_000):
            p, q = i[start: start + 20_000], d[start: start + 20_000]
            x = table[:k, q].T.astype(float)
            meets = q == cls[p]
            x[meets] -= theirs[p[meets], :k]
            r = np.flatnonzero(inside[p])
            x[r, cls[p[r]]] -= mine[p[r], q[r]] + own[p[r]] * meets[r]
            x = np.maximum(x, 0)
            add = _xlogx(x + mine[p, q][:, None]) - _xlogx(x)
            c = np.flatnonzero(q < k)
            add[c, q[c]] = 0  # the corner, below
            np.add.at(gain, p, add)
        total = mine.sum(axis=1) + own
        sums = np.repeat(table.sum(axis=1)[None, :k].astype(float), many, axis=0)
        sums[w, at] -= total[w]
        gain -= _xlogx(sums + total[:, None]) - _xlogx(sums)
    corner = right[:, :k] + left[:, :k] + own[:, None]
    x = np.repeat(np.diagonal(big)[None, :k].astype(float), many, axis=0)
    x[w, at] -= corner[w, at]
    x = np.maximum(x, 0)
    return gain + _xlogx(x + corner) - _xlogx(x)


def _moved(big: np.ndarray):
    """A bucket's cells from the blocks, and its rows for the blocks with its words' classes -> the classes with the largest gain, one row."""
    size, k = len(big), len(big) - 2
    width = 2 * size + 1

    def run(cells: pa.Table, words: pa.Table) -> pa.Table:
        posts, classes = {}, []
        for block, at, c in zip(*(words.column(x) for x in ("block", "at", "class"))):
            if c.is_valid:
                classes.append((_unpacked(at.as_py()), _unpacked(c.as_py())))
            else:
                posts[block.as_py()] = _unpacked(at.as_py())
        now = np.full(1 + max((int(x.max()) for x in posts.values()), default=-1), size - 2)
        for at, c in classes:
            now[at] = c
        codes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for block, many, code, n in zip(*(cells.column(x) for x in ("block", "many", "code", "n"))):
            codes.append(np.repeat(posts[block.as_py()], _unpacked(many.as_py())) * width + _unpacked(code.as_py()))
            counts.append(_unpacked(n.as_py()))
        code, back = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(back, np.concatenate(counts), minlength=len(code)).astype(np.int64)
        word, first = np.unique(code // width, return_index=True)
        first = np.append(first, len(code))
        out = np.empty(len(word), np.int64)
        for a in range(0, len(word), 2000):
            ids = word[a: a + 2000]
            i, j = first[a], first[a + len(ids)]
            cls = now[ids]
            gain = move_gains(big, cls, np.repeat(np.arange(len(ids)), np.diff(first[a: a + len(ids) + 1])), code[i:j] % width, n[i:j])
            best, rows = gain.argmax(axis=1), np.arange(len(ids))
            stays = (cls < k) & (gain[rows, best] <= gain[rows, np.minimum(cls, k - 1)] + 1e-9)
            out[a: a + len(ids)] = np.where(stays, cls, best)
        return pa.table({"bucket": pa.array([words.column("bucket")[0].as_py()], pa.int32()), "at": pa.array([_packed(word)], pa.binary()), "class": pa.array([_packed(out)], pa.binary())})

    return run


def _class_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.bincount(np.concatenate([np.empty(0, np.int64), *(_unpacked(x.as_py()) for x in batch.column("class"))]))
        yield pa.record_batch({"class": pa.array(np.arange(len(n), dtype=np.int32)), "n": pa.array(n.astype(np.int64))})


def likelihood(big: np.ndarray) -> float:
    return float(_xlogx(big).sum() - _xlogx(big.sum(axis=0)).sum() - _xlogx(big.sum(axis=1)).sum())


def _bigrams(top: list[bytes]):
    """Training texts -> counts of neighbouring symbols; len(top) is the open class, len(top) + 1 the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_, size = {w: k for k, w in enumerate(top)}, len(top), len(top) + 2
        counts = np.zeros(size * size, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                words = tokens(text.as_py())
                s = np.fromiter(map(number.get, words, repeat(open_)), np.int64, len(words))
                s = np.concatenate([[size - 1], s, [size - 1]])
                code, n = np.unique(s[:-1] * size + s[1:], return_counts=True)
                counts[code] += n
        code = np.flatnonzero(counts)
        yield pa.record_batch({"code": code, "n": counts[code]})

    return run


def exchange_classes(counts: np.ndarray, words: int, classes: int, sweeps: int = 20) -> np.ndarray:
    """Class of each symbol: the first `words` are clustered, the others are fixed classes after them.

    counts: bigram counts of the symbols.  The objective is the class-bigram
    log-likelihood sum N(c,d) log N(c,d) - sum left log left - sum right log right.
    """
    fixed = counts.shape[0] - words
    k = min(classes, words)
    cls = np.concatenate([np.arange(words) % max(k, 1), k + np.arange(fixed)])  # frequent words first: each class starts with one
    total = k + fixed
    xlogx = lambda x: x * np.log(np.maximum(x, 1))
    rows, cols = np.zeros((counts.shape[0], total)), np.zeros((counts.shape[0], total))  # symbol -> class, class -> symbol
    for c in range(total):
        rows[:, c] = counts[:, cls == c].sum(axis=1)
        cols[:, c] = counts[cls == c].sum(axis=0)
    big = np.array([rows[cls == c].sum(axis=0) for c in range(total)])
    for _ in range(sweeps):
        moved = False
        for w in range(words):
            a, own = cls[w], counts[w, w]
            right, left = rows[w].copy(), cols[w].copy()
            right[a] -= own
            left[a] -= own
            # without w
            big[a] -= right
            big[:, a] -= left
            big[a, a] -= own
            lefts, rights = big.sum(axis=1), big.sum(axis=0)
            gain = np.empty(k)
            for c in range(k):
                r, l = right.copy(), left.copy()
                corner = r[c] + l[c] + own
                r[c] = l[c] = 0
                gain[c] = ((xlogx(big[c] + r) - xlogx(big[c])).sum() + (xlogx(big[:, c] + l) - xlogx(big[:, c])).sum()
                           + xlogx(big[c, c] + corner) - xlogx(big[c, c])
                           - xlogx(lefts[c] + right.sum() + own) + xlogx(lefts[c]) - xlogx(rights[c] + left.sum() + own) + xlogx(rights[c]))
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            big[b] += right
            big[:, b] += left
            big[b, b] += own
            if b != a:
                moved = True
                cls[w] = b
                rows[:, a] -= counts[:, w]
                rows[:, b] += counts[:, w]
                cols[:, a] -= counts[w]
                cols[:, b] += counts[w]
        if not moved:
            break
    return cls


class ClassModel:
    """Log10 probabilities: `transition[c, d]`, and per class the smoothed emission."""

    def __init__(self, top: list[bytes], cls: np.ndarray, counts: np.ndarray, n_open: int, types_open: int, alpha: float, beta: float):
        self.top, self.cls = {w: int(cls[k]) for k, w in enumerate(top)}, cls
        self.open, self.end = int(cls[-2]), int(cls[-1])
        k = int(cls.max()) + 1
        big = np.zeros((k, k))
        np.add.at(big, (cls[:, None], cls[None, :]), counts)
        unigram = (big.sum(axis=0) + 1) / (big.sum() + k)
        self.transition = np.log10((big + beta * unigram) / (big.sum(axis=1, keepdims=True) + beta))
        size, types = big.sum(axis=0), np.bincount(cls, minlength=k).astype(float)
        size[self.open], types[self.open] = n_open, types_open + 1  # one share for what was never seen
        self.size, self.types, self.alpha = size, types, alpha

    @classmethod
    def of_classes(cls, big: np.ndarray, types: np.ndarray, alpha: float, beta: float) -> ClassModel:
        """From the matrix of classes by classes and the number of words in each; every word seen has a class."""
        model = cls([], np.arange(len(big)), big, int(big[:, -2].sum()), int(types[-2]), alpha, beta)
        model.types[:-2] = types[:-2]
        # never seen in training, so no class leads to the open one more than another: it keeps its share of the unigram
        p, share = 10 ** model.transition, 1 / (big.sum() + len(big))
        p *= (1 - share) / (1 - p[:, -2:-1])
        p[:, -2] = share
        model.transition = np.log10(p)
        return model

    def emission(self, cls: np.ndarray, count: np.ndarray) -> np.ndarray:
        p = (count + self.alpha) / (self.size[cls] + self.alpha * self.types[cls])
        return np.where(cls == self.end, 0.0, np.log10(p))


def _score(model: ClassModel, total: int, types: int, ends: int):
    def run(rows: pa.Table, placed: pa.Table) -> pa.Table:
        codes, _, places, classes, totals = _met(rows, placed)
        texts = [_unpacked(c) for c in codes]
        docs = rows.filter(pc.is_valid(rows.column("codes")))
        n = len(places)
        count, cls = np.zeros(n + 1, np.int64), np.full(n + 1, model.open)
        count[places], cls[places] = totals, classes
        count[-1], cls[-1] = ends, model.end
        base = np.log10((count + 1) / (total + types + 1))
        emit = model.emission(cls, count)
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for text in texts:
            at = np.append(text, n)
            c = cls[at]
            out["n_tokens"].append(len(at))
            out["n_known"].append(int((count[at] > 0).sum()))
            out["base_score"].append(float(base[at].sum()))
            out["score"].append(float(emit[at].sum() + model.transition[np.append(model.end, c[:-1]), c].sum()))
        return pa.table({"id": docs.column("id"), "held_out": docs.column("held_out")} | out)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: Column | None = None, vocabulary: int = 500, classes: int = 32,
          alpha: float = 1.0, beta: float = 50.0, sweeps: int = 2) -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    out: boolean column, true for the rows that are not learned from (default: held_out(id)).
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/class-lm-{uuid.uuid4().hex}"
    ship_package(spark)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (held_out(F.col(id_col)) if out is None else out).alias("held_out"))
    size, ends = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))).first()
    n_blocks = 1 + int(size) // BLOCK_BYTES
    base = base.withColumn("block", F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(n_blocks)).cast("int"))
    kind = dict(base.dtypes)["id"]
    id_type = to_arrow_type(base.schema["id"].dataType)
    buckets = 2 * n_blocks
    (base.groupBy("block").applyInArrow(_encode(id_type, buckets), f"block int, id {kind}, held_out boolean, codes binary, bucket int, places binary, words binary, counts binary")
     .write.option("compression", "zstd").parquet(f"{folder}/encoded"))
    release_shuffles(spark)
    encoded = spark.read.parquet(f"{folder}/encoded")
    # of a block the texts, and its words' places by bucket
    texts = encoded.select("block", "id", "held_out", "codes", "bucket", "places")
    train = texts.where("codes is null or not held_out").drop("id", "held_out")
    (encoded.where("words is not null").select("bucket", "block", "words", "counts").groupBy("bucket")
     .applyInArrow(_count(vocabulary), "bucket int, block int, at binary, totals binary, word binary, n long, place int").write.option("compression", "zstd").parquet(f"{folder}/counted"))
    release_shuffles(spark)
    counted = spark.read.parquet(f"{folder}/counted")
    n_words, types = counted.where("block = -1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("place"), F.lit(0))).first()
    top = [(bytes(r.word), r.bucket, r.place) for r in counted.where("block = -2").orderBy(F.desc("n"), "word").limit(vocabulary).select("word", "bucket", "place").collect()]
    width = len(top) + 2
    counts = np.zeros(width * width, np.int64)
    cells = base.where(~F.col("held_out")).select("text").mapInArrow(_bigrams([w for w, *_ in top]), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    for r in cells.collect():  # at most (vocabulary + 2) squared
        counts[r.code] = r.n
    seeds = exchange_classes(counts.reshape(width, width), len(top), classes)
    size = int(seeds.max()) + 1
    big = np.zeros((size, size), np.int64)
    np.add.at(big, (seeds[:, None], seeds[None, :]), counts.reshape(width, width))

    def placed(of: DataFrame, counts: bool = False) -> DataFrame:
        return (counted.where("block >= -1").select("bucket", "block", "at", "totals").groupBy("bucket").cogroup(of.groupBy("bucket"))
                .applyInArrow(_placed(size - 2, counts), "block int, bucket int, class binary, totals binary"))

    def neighbours(of: DataFrame, words: bool) -> DataFrame:
        return (train.groupBy("block").cogroup(placed(of).groupBy("block"))
                .applyInArrow(_neighbours(size, words), "bucket int, block int, many binary, code binary, n binary" if words else "code int, n long"))

    def move(of: DataFrame, big: np.ndarray) -> DataFrame:
        known = (counted.where("block >= 0").select("bucket", "block", "at", F.lit(None).cast("binary").alias("class"))
                 .unionByName(of.select("bucket", F.lit(-1).alias("block"), "at", "class")))
        return (neighbours(of, True).groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_moved(big), "bucket int, at binary, class binary").checkpoint())

    def matrix(of: DataFrame) -> np.ndarray:
        out = np.zeros(size * size, np.int64)
        for r in neighbours(of, False).groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most classes + 2 squared
            out[r.code] = r.n
        return out.reshape(size, size)

    # seeds have a class, all other words come from the open one
    found = spark.createDataFrame([(b, _packed(np.array([at])), _packed(np.array([c]))) for (_, b, at), c in zip(top, seeds)], "bucket int, at binary, class binary")
    for sweep in range(sweeps if top else 0):
        release_shuffles(spark)
        moved = move(found, big)
        release_shuffles(spark)
        after = matrix(moved)
        if sweep and likelihood(after) <= likelihood(big):  # the first one takes the words out of the open class
            break
        found, big = moved, after
    release_shuffles(spark)
    n_types = np.zeros(size, np.int64)
    for r in found.select("class").mapInArrow(_class_sizes, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        n_types[r["class"]] = r.n
    model = ClassModel.of_classes(big, n_types, alpha, beta)
    train_tokens = int(n_words) + int(ends)
    scored = (texts.groupBy("block").cogroup(placed(found, counts=True).groupBy("block"))
              .applyInArrow(_score(model, train_tokens, int(types) + (ends > 0), int(ends)),
                            f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
                         F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
