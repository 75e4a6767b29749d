"""Benchmark decontamination by winnowing; DataFrame functions only.

A window is `length` consecutive words of a benchmark item (the whole item if it
is shorter).  Every window keeps the least hash of its k-grams as fingerprint.
Documents are winnowed alike: the least k-gram hash of every sliding window of
the same number of words.  Equal windows have equal fingerprints, so each span of
`length` shared words meets at least one fingerprint of the benchmark; a document
window whose fingerprint is met is extended to its words and compared with the
benchmark's windows of these words.  Nothing is estimated: hashes only choose
what is compared.

Documents are read once.  The benchmark's fingerprints and windows are counted
and broadcast up to `BROADCAST_ROWS`; beyond it, documents send their distinct
fingerprints through a shuffled join, and only those of the documents that meet
one are looked up again.  Lists of items are interned: a window leads to the name
of its set of items, and the items are united once for every distinct combination
of sets instead of once for every document.

Defined results: null has no words; a document without words, or an empty
benchmark, gives no hit and the digest of the empty list; rows that repeat an id
and its text get one row each; an item that repeats an id adds its windows to it;
an item without id marks words but names no item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.lookup import BROADCAST_ROWS, size_checked
from vitrine.session import ensure_checkpoint_dir

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPANS = "array<struct<start:int,end:int>>"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case; `lower` serves where all characters are ASCII."""
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def with_fingerprints(rows: DataFrame, length: Column, k: int, out: str, words: str = "words") -> DataFrame:
    """rows with `out`: for every window of `length` words, in order, the least hash of its grams of k words (of all its words, if fewer)."""
    gram = F.least(F.lit(k), length)
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - gram + 1), lambda i: F.xxhash64(length, F.slice(words, i, gram)))
    rows = rows.withColumn("__grams", F.when(F.size(words) >= length, grams))
    width = length - gram + 1
    minima = F.transform(F.sequence(F.lit(1), F.size("__grams") - width + 1), lambda i: F.array_min(F.slice("__grams", i, width)))
    return rows.withColumn(out, F.when(F.col("__grams").isNotNull(), minima)).drop("__grams")


def windows_of(items: DataFrame, length: int, k: int) -> DataFrame:
    """items: item, text -> every distinct window: win (its words), len, print, items (sorted names)."""
    words = items.select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).withColumn("len", F.least(F.lit(length), F.size("words")))
    # outer: a plain explode's inferred filter would work out the fingerprints again for every gram
    rows = (with_fingerprints(words, F.col("len"), k, "prints").select("item", "words", "len", F.posexplode_outer("prints").alias("at", "print"))
            .select("item", "len", "print", F.array_join(F.slice("words", F.col("at") + 1, F.col("len")), " ").alias("win")))
    return rows.groupBy("win", "len", "print").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _merged(windows: Column) -> Column:
    """Sorted windows (start, end) -> the spans they cover."""
    def span(a):
        return F.when(a["end"] > a["start"], F.array(F.struct(a["start"].alias("start"), a["end"].alias("end")))).otherwise(F.array().cast(SPANS))

    def state(done, start, end):
        return F.struct(done.cast(SPANS).alias("done"), start.cast("int").alias("start"), end.cast("int").alias("end"))

    return F.aggregate(windows, state(F.array(), F.lit(0), F.lit(0)),
                       lambda a, w: F.when(w["start"] > a["end"], state(F.concat(a["done"], span(a)), w["start"], w["end"]))
                       .otherwise(state(a["done"], F.when(a["end"] > a["start"], a["start"]).otherwise(w["start"]), F.greatest(a["end"], w["end"]))),
                       lambda a: F.concat(a["done"], span(a)))


def _met(texts: DataFrame, lengths: list[int], prints: DataFrame, small: bool) -> DataFrame:
    """Windows of the documents whose fingerprint is one of the benchmark's: id, hash, n_words, at (from 1), len, win.

    Every document has one more row with `at` 0 and a `win` that no window equals.
    """
    classes = F.array(*[F.struct(F.lit(n).alias("len"), F.lit(k == 0).alias("head"), F.concat(F.array(F.lit(None).cast("long")), F.coalesce(F.col(f"prints_{n}"), F.array().cast("array<long>"))).alias("prints"))
                        for k, n in enumerate(lengths)])

    def placed(rows: DataFrame, *more: str) -> DataFrame:
        return (rows.select("id", "hash", "words", *more, F.explode(classes).alias("c"))
                .select("id", "hash", "words", *more, "c.len", "c.head", F.posexplode("c.prints").alias("at", "print")))

    if small:
        hit = placed(texts).join(F.broadcast(prints.withColumn("met", F.lit(True))), "print", "left")
    else:
        every = F.array_distinct(F.flatten(F.array_compact(F.array(*[F.col(f"prints_{n}") for n in lengths]))))
        met = texts.select("hash", F.explode_outer(every).alias("print")).distinct().join(prints, "print", "left_semi").groupBy("hash").agg(F.collect_set("print").alias("met_prints"))
        hit = placed(texts.join(met, "hash", "left"), "met_prints").withColumn("met", F.array_contains("met_prints", F.col("print")))
    head = F.col("head") & (F.col("at") == 0)
    return (hit.where(head | (F.col("met") & (F.col("at") > 0)))
            .select("id", "hash", F.size("words").alias("n_words"), "at", "len",
                    F.when(head, F.concat(F.lit(" "), "hash")).otherwise(F.array_join(F.slice("words", F.greatest("at", F.lit(1)), F.col("len")), " ")).alias("win")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  length: int = 10, k: int = 5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs: id, n_words, spans (words from..to that occur in a window), n_hit, n_items, items_sha256, contaminated."""
    ensure_checkpoint_dir(docs.sparkSession)
    # a window, its words and the name of its set of items; sets are stored once
    stored = windows_of(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")), length, k)
    stored = stored.withColumn("bag", F.md5(F.array_join("items", ",").cast("binary"))).checkpoint()
    windows, prints = stored.select("win", "bag"), stored.select("print").distinct().checkpoint()
    bags = stored.select("bag", "items").dropDuplicates(["bag"])
    lengths = sorted(r[0] for r in stored.select("len").distinct().collect()) or [length]  # at most `length` numbers
    small = stored.limit(broadcast_rows + 1).count() <= broadcast_rows

    text = F.col(text_col)
    texts = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("hash"), words_of(text).alias("words"))
    for n in lengths:
        texts = with_fingerprints(texts, F.lit(n), k, f"prints_{n}")
    met = _met(texts, lengths, prints, small)
    known = F.broadcast(windows) if small else windows
    hit = met.join(known, "win", "left").where("at = 0 or bag is not null")
    window = F.struct((F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.col("len")).alias("end"))
    per = (hit.groupBy("id", "hash").agg(F.max("n_words").cast("long").alias("n_words"), F.sum((F.col("at") == 0).cast("int")).alias("rows"),
                                         F.collect_set(F.when(F.col("at") > 0, window)).alias("windows"), F.sort_array(F.collect_set("bag")).alias("bags"))
           .select("id", "n_words", "rows", _merged(F.array_sort("windows")).alias("spans"), "bags").checkpoint())

    united = (per.select("bags").where(F.size("bags") > 0).distinct().select("bags", F.explode("bags").alias("bag")).join(bags, "bag")
              .select("bags", F.explode_outer("items").alias("item")).groupBy("bags").agg(F.sort_array(F.collect_set("item")).alias("items"))
              .select("bags", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).checkpoint())
    clean = per.where(F.size("bags") == 0).withColumn("n_items", F.lit(0).cast("long")).withColumn("items_sha256", F.sha2(F.lit(""), 256))
    dirty = per.where(F.size("bags") > 0).join(size_checked(united), "bags")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return (clean.unionByName(dirty).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select(F.col("id").alias(id_col), "n_words", "spans", n_hit.alias("n_hit"), "n_items", "items_sha256", (F.size("spans") > 0).alias("contaminated")))
