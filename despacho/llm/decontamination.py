"""Benchmark decontamination by a prefix-filtered set join; expressions alone, no Python on an executor.

A window is ten consecutive words of an item, or the whole of a shorter item.
As a set it is made of shingles of three words. To hold a window a document
must hold all its shingles, so one of them, the window's prefix, is enough to
find every candidate: the one that is rarest in the documents. Candidates that
would begin before the document or end after it fall out, and the rest count
only if the document's words at that place equal the window's. Words don't go
with the shingles: a document with candidates is met again as one row, so what
a document takes grows with its length alone.

Defined cases: a null or empty text has no words; items without words have no
windows; items without an id hit words but are not listed; repeated items count
once; repeated documents are each reported; no items or no documents give no
hits or no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import fresh, written
from despacho.operators.joins import BROADCAST_BYTES, broadcast_small

WINDOW = 10
SHINGLE = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
REST = 2**31 - 1


def words(text: Column) -> Column:
    """Runs of 0-9, a-z and all beyond ASCII, after A-Z became a-z."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), NOT_WORD)
    first = F.when(F.get(parts, 0) == "", 1).otherwise(0)
    last = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.slice(parts, first + 1, F.greatest(F.size(parts) - first - last, F.lit(0)))


def _shingle_hash(row: Column, size: int) -> Column:
    parts = [row[f"w{i}"] for i in range(size)]
    return F.when(reduce(Column.__and__, [p.isNotNull() for p in parts]), F.xxhash64(F.lit(size), *parts))


def _hashes(row: Column, sizes: list[int]) -> Column:
    return F.array(*[_shingle_hash(row, n) for n in sizes])


def _shingles(df: DataFrame, sizes: list[int], *kept: str) -> DataFrame:
    """Rows of ``position`` and shingle ``hash`` for the column ``words``, and per input row one with null in both."""
    columns = [F.concat(F.array(F.lit(None).cast("string")), "words").alias("w0")]
    columns += [F.slice("words", i, REST).alias(f"w{i}") for i in range(1, max(sizes))]
    rows = df.select(*kept, F.posexplode(F.arrays_zip(*columns)).alias("position", "row"))
    rows = rows.withColumn("position", F.when(F.col("position") > 0, F.col("position")))
    if len(sizes) == 1:
        return rows.select(*kept, "position", _shingle_hash(F.col("row"), sizes[0]).alias("hash"))
    marked = F.when(F.col("position").isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(
        F.array_compact(_hashes(F.col("row"), sizes))
    )
    return rows.select(*kept, "position", F.explode(marked).alias("hash"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window of every item: item_id, its words as ``window`` and their text as ``window_text``."""
    with_words = items.select(F.col("item_id"), words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - F.lit(window) + 1, F.lit(1))
    starts = with_words.select("item_id", "words", F.explode(F.sequence(F.lit(1), last)).alias("start"))
    return starts.select("item_id", F.slice("words", F.col("start"), window).alias("window")).select(
        "item_id", "window", F.array_join("window", " ").alias("window_text")
    )


def _prefixes(docs: DataFrame, windows: DataFrame, shingle: int, limit: int) -> tuple[DataFrame, list[int]]:
    """For each window its rarest shingle with its place in the window; and the sizes of shingles in use."""
    size = F.least(F.size("window"), F.lit(shingle))
    length = F.size("window").alias("length")
    sized = windows.select("window_text", F.col("window").alias("words"), length, size.alias("size")).distinct()
    sizes = sorted(r["size"] for r in sized.select("size").distinct().limit(shingle).collect())
    if not sizes:
        return None, []
    parts = reduce(
        DataFrame.unionAll,
        [
            _shingles(sized.filter(F.col("size") == n), [n], "window_text", "length").filter("hash is not null")
            for n in sizes
        ],
    ).select("window_text", "length", (F.col("position") - 1).alias("offset"), "hash")
    parts = written(parts, "window-shingles")
    [wanted] = broadcast_small(parts.select("hash").distinct(), limit=limit)
    found = _shingles(docs, sizes).filter("hash is not null").select("hash")
    if wanted.small:
        counts = wanted.join_to(found, "hash").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = wanted.join_to(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "hash")
    # A window one of whose shingles is nowhere in the documents has no prefix: it can't occur.
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("rarest")
    prefixes = parts.join(counts, "hash", "left").groupBy("window_text", "length").agg(rarest)
    prefixes = prefixes.filter("rarest.n > 0").select("window_text", "length", "rarest.hash", "rarest.offset")
    return written(prefixes, "window-prefixes"), sizes


def _covered(spans: Column) -> Column:
    """How many positions a sorted array of (start, length) covers."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(seen: Column, span: Column) -> Column:
        end = F.greatest(seen["end"], span["start"] + span["length"])
        return F.struct((seen["n"] + end - F.greatest(seen["end"], span["start"])).alias("n"), end.alias("end"))

    return F.aggregate(spans, start, step, lambda seen: seen["n"])


CANDIDATES = "array<struct<start: int, length: int, window_text: string>>"


def _candidates(docs: DataFrame, windows: DataFrame, shingle: int, limit: int) -> DataFrame:
    """Per document (doc_id, digest, n_words) its number of rows and the places where a window's prefix fits."""
    key = ["doc_id", "digest", "n_words"]
    prefixes, sizes = _prefixes(docs, windows, shingle, limit)
    if not sizes:
        rows = docs.select(*key, F.lit(1).alias("base"), F.array().cast(CANDIDATES)[0].alias("place"))
        rows = rows.withColumn("place", F.when(F.lit(False), F.col("place")))
    else:
        begin = F.col("position") - 1 - F.col("offset")
        in_bounds = (begin >= 0) & (begin + F.col("length") <= F.col("n_words"))
        place = F.struct(begin.alias("start"), "length", "window_text")
        [small] = broadcast_small(prefixes, limit=limit)
        found = _shingles(docs, sizes, *key)
        if small.small:
            base = F.when(F.col("position").isNull(), 1).otherwise(0).alias("base")
            rows = small.join_to(found, "hash", "left").filter(F.col("position").isNull() | in_bounds)
            rows = rows.select(*key, base, F.when(in_bounds, place).alias("place"))
        else:
            rows = found.filter("hash is not null").join(prefixes, "hash").filter(in_bounds)
            rows = rows.select(*key, F.lit(0).alias("base"), place.alias("place"))
            rows = rows.unionAll(docs.select(*key, F.lit(1), F.lit(None).cast(rows.schema["place"].dataType)))
    return rows.groupBy(*key).agg(F.sum("base").alias("copies"), F.collect_set("place").cast(CANDIDATES).alias("candidates"))


def _same(left_id: str, left_digest: str, right_id: str, right_digest: str) -> Column:
    return F.col(left_id).eqNullSafe(F.col(right_id)) & (F.col(left_digest) == F.col(right_digest))


def _verified(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents (d, g) where windows occur: how many words they cover, and their digests."""
    open_ = candidates.filter(F.size("candidates") > 0).select(F.col("doc_id").alias("d"), F.col("digest").alias("g"), "candidates")
    [ids] = broadcast_small(open_.select("d", "g"))
    held = texts.join(ids.rows, _same("doc_id", "digest", "d", "g"), "left_semi").dropDuplicates(["doc_id", "digest"])
    both = open_.join(held, _same("d", "g", "doc_id", "digest"))

    def occurs(words_: Column) -> Column:
        def equal(c: Column) -> Column:
            return F.array_join(F.slice(words_, c["start"] + 1, c["length"]), " ") == c["window_text"]

        return F.filter("candidates", equal)

    # The words are bound to a name, so that they are taken from the text once and not per candidate.
    found = F.element_at(F.transform(F.array(words(F.col("text"))), occurs), 1)
    spans = F.array_sort(F.array_distinct(F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length")))))
    digests = F.array_distinct(F.transform("found", lambda c: F.md5(c["window_text"])))
    return both.select("d", "g", found.alias("found")).filter(F.size("found") > 0).select(
        "d", "g", _covered(spans).alias("n_hit"), digests.alias("windows")
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Per document (doc_id, text) the words that lie in windows of items, and those items."""
    # Texts are told apart by a digest, so that equal ids with different texts stay apart.
    texts = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    worded = texts.select("doc_id", "digest", words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    windows = item_windows(items, window)
    candidates = written(_candidates(worded, windows, shingle, limit), "document-candidates")
    hits = written(_verified(candidates, texts), "document-hits")
    members = windows.select(F.md5("window_text").alias("window"), F.col("item_id").cast("string").alias("item_id")).distinct()
    listed = F.concat_ws(",", F.array_sort(F.collect_set("item_id")))
    by_doc = (
        hits.select("d", "g", "n_hit", F.explode("windows").alias("window"))
        .join(members, "window")
        .groupBy("d", "g", "n_hit")
        .agg(F.countDistinct("item_id").alias("n_items"), listed.alias("items"))
    )
    result = candidates.drop("candidates").join(by_doc, _same("doc_id", "digest", "d", "g"), "left")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return result.select("*", copies.alias("copy")).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "digest",
    )


def document_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).drop("digest")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, in which no window of an item occurs."""
    hit_id, hit_digest = fresh(docs, "hit_id"), fresh(docs, "hit_digest")
    hit = contamination(docs, items).filter("contaminated").select(F.col("doc_id").alias(hit_id), F.col("digest").alias(hit_digest))
    same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.md5(F.coalesce("text", F.lit(""))) == F.col(hit_digest))
    return docs.join(hit.distinct(), same, "left_anti")


SQL = rf"""
with doc_words as (
    select row_number() over () as row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w
    from documents
), item_words as (
    select item_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w
    from benchmark
), windows as (
    select distinct item_id, array_to_string(w[s : s + {WINDOW} - 1], ' ') as window_text, least(len(w), {WINDOW}) as length
    from (select *, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) as s from item_words where len(w) > 0)
), lengths as (
    select distinct length from windows
), places as (
    select row_id, length, s, array_to_string(w[s : s + length - 1], ' ') as window_text
    from (select *, unnest(range(1, len(w) - length + 2)) as s from doc_words, lengths where len(w) >= length)
), hits as (
    select row_id, s, places.length, item_id from places join windows using (window_text)
), covered as (
    select row_id, count(distinct position) as n_hit
    from (select row_id, unnest(range(s, s + length)) as position from hits) group by row_id
), listed as (
    select row_id, count(*) as n_items, string_agg(id, ',' order by id) as items
    from (select distinct row_id, item_id::varchar as id from hits where item_id is not null) group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join covered using (row_id) left join listed using (row_id)
"""
