"""Line deduplication across documents by a segment-partition edit join. DataFrame operations only.

Lines are the parts of a text between line feeds; those of ``least`` characters or more take part. The place of a line is
(document, text digest, number); the first place of equal lines counts. A line goes if an equal line stands at an earlier
place, or if a line within ``edits`` character edits has an earlier first place.

Two lines within ``edits`` edits share one of ``edits + 1`` segments of the shorter one, shifted by a bounded number of
characters. Without that segment the rests are within ``edits`` edits again, so they share a segment too: a key joins
``levels`` such segments, and lines that merely begin or end alike don't meet. Every first line puts its keys into an index
by (length, segment numbers, contents) and probes the index of lines up to ``edits`` shorter with the substrings that can
match. Pairs that share a key are verified by the banded edit distance with a threshold.

Segments are hashed where the text is read; the tables of first lines, index and probes hold keys and places only. Texts
are shuffled once, when the lines that stay are put into their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import stored

PLACE = ("key", "digest", "pos")
BROADCAST = 16 << 20  # bytes of candidate places


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start and length of segment ``i`` (from 0) of ``parts`` of a line of ``length`` characters; longer ones come last."""
    size = F.floor(length / parts).cast("int")
    longer = (length % parts).cast("int")
    short = parts - longer  # segments of the plain size
    start = F.lit(1) + size * i + F.greatest(F.lit(0), F.lit(i) - short)
    return start, size + F.when(F.lit(i) >= short, 1).otherwise(0)


def _rest(line: Column, at: Column, n: Column) -> Column:
    return F.concat(F.substring(line, F.lit(1), at - 1), F.substring(line, at + n, F.length(line)))


def index_keys(line: Column, edits: int, levels: int) -> Column:
    """Keys of a line: each segment, joined at the next level with each segment of the rest of the line, and so on."""

    def keys(part: Column, size: Column, before: Column, levels: int) -> list[Column]:
        out = []
        for i in range(edits + 1):
            start, n = _segment(size, i, edits + 1)
            head = F.xxhash64(before, F.lit(i), F.substring(part, start, n))
            out += keys(_rest(part, start, n), size - n, head, levels - 1) if levels > 1 else [head]
        return out

    return F.array(*keys(line, F.length(line), F.length(line), levels))


def probe_keys(line: Column, edits: int, least: int, levels: int) -> Column:
    """Keys of all substrings by which a line of the same length or up to ``edits`` shorter can be met."""

    def keys(part: Column, size: Column, before: Column, shorter: int, levels: int, fits: Column) -> list[Column]:
        out = []
        for i in range(edits + 1):
            start, n = _segment(size - shorter, i, edits + 1)
            rest = edits - i  # edits that are left behind this segment if all before it are used up
            for shift in range(max(-i, shorter - rest), min(i, shorter + rest) + 1):
                at = start + shift
                ok = fits & (at >= 1) & (at + n - 1 <= size)
                head = F.xxhash64(before, F.lit(i), F.substring(part, at, n))
                out += keys(_rest(part, at, n), size - n, head, shorter, levels - 1, ok) if levels > 1 else [F.when(ok, head)]
        return out

    size, out = F.length(line), []
    for shorter in range(edits + 1):
        out += keys(line, size, size - shorter, shorter, levels, size - shorter >= least)
    return F.array(*out)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.xxhash64(F.lit(1), F.col(text)).alias("digest"), F.col(text).alias("text"))


def _at(rows: DataFrame, places: DataFrame, places_column: str) -> DataFrame:
    """Rows joined with the places of their document; null keys are a document too."""
    p = places.select(F.col("key").alias("k"), F.col("digest").alias("d"), places_column)
    return rows.join(p, F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))).drop("k", "d")


def kept_places(docs: DataFrame, edits: int = 1, least: int = 20, key: str = "doc_id", text: str = "text", levels: int = 2) -> DataFrame:
    """``key``, ``digest`` and the numbers ``kept`` (from 0) of the lines that stay, of those that take part."""
    texts = _texts(docs, key, text)
    lines = texts.select("key", "digest", F.posexplode_outer(_lines(F.col("text"))).alias("pos", "line")).where(F.length("line") >= least)
    # Equal lines by a 128-bit hash: their first place, with the keys of its segments. A repeated line is reduced map-side.
    first = F.struct(*PLACE, index_keys(F.col("line"), edits, levels).alias("index"), probe_keys(F.col("line"), edits, least, levels).alias("probes"))
    firsts = (
        lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line", F.length("line")).alias("h2"), first.alias("first"))
        .groupBy("h1", "h2").agg(F.min("first").alias("first")).select("first.*")
    )
    firsts = stored(firsts)

    def side(keys: str, name: str) -> DataFrame:
        return firsts.select(F.struct(*PLACE).alias(name), F.explode_outer(keys).alias("seg")).where("seg is not null")

    pairs = side("index", "a").join(side("probes", "b"), "seg").where("a != b")
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    met = pairs.select(F.explode(F.array("a", "b")).alias("p")).select("p.*").groupBy("key", "digest").agg(F.collect_set("pos").alias("places"))
    size = met.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("lines")).first()
    # Few candidates, by measured size, go to the texts; many meet them in a shuffle by document.
    met = F.broadcast(met) if 64 * size["n"] + 4 * size["lines"] <= BROADCAST else met
    met_lines = (
        _at(texts, met, "places").select("key", "digest", _lines(F.col("text")).alias("all"), F.explode_outer("places").alias("pos"))
        .select(F.struct(*PLACE).alias("place"), F.get("all", "pos").alias("line")).distinct()
    )
    first = met_lines.select(F.col("place").alias("pa"), F.col("line").alias("line_a"))
    second = met_lines.select(F.col("place").alias("pb"), F.col("line").alias("line_b"))
    close = F.levenshtein("line_a", "line_b", edits)
    late = (
        pairs.join(first, F.col("a").eqNullSafe(F.col("pa"))).join(second, F.col("b").eqNullSafe(F.col("pb")))
        .where((close >= 0) & (close <= edits)).select("b.*").groupBy("key", "digest").agg(F.collect_set("pos").alias("late"))
    )
    firsts = firsts.groupBy("key", "digest").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    late = late.select(F.col("key").alias("k"), F.col("digest").alias("d"), "late")
    kept = (
        firsts.join(late, F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")), "left")
        .select("key", "digest", F.when(F.col("late").isNull(), F.col("places")).otherwise(F.array_sort(F.array_except("places", "late"))).alias("kept"))
    )
    before = lambda j: F.coalesce(F.get("kept", j - 1), F.lit(-1))
    marks = F.array_join(F.transform("kept", lambda p, j: F.concat(F.repeat(F.lit("0"), p - before(j) - 1), F.lit("1"))), "")
    return kept.select("key", "digest", marks.cast("binary").alias("marks"))


def _cleaned(docs: DataFrame, edits: int, least: int, key: str, text: str, levels: int, mark: str) -> DataFrame:
    """``docs`` with the array ``mark`` of the lines that stay."""
    kept = kept_places(docs, edits, least, key, text, levels)
    kept = kept.select(F.col("key").alias("_op9_key"), F.col("digest").alias("_op9_digest"), F.col("marks").alias("_op9_marks"))
    digest = F.xxhash64(F.lit(1), F.col(text))
    joined = docs.join(kept, docs[key].eqNullSafe(F.col("_op9_key")) & (digest == F.col("_op9_digest")), "left")
    # One byte for each line, so that looking up a line doesn't depend on how many there are.
    stays = lambda i: F.coalesce(F.substring("_op9_marks", i + 1, F.lit(1)) == F.lit(b"1"), F.lit(False))
    return joined.withColumn(mark, F.filter(_lines(F.col(text)), lambda line, i: (F.length(line) < least) | stays(i)))


def dedup(docs: DataFrame, edits: int = 1, least: int = 20, key: str = "doc_id", text: str = "text", levels: int = 2) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``; all rows and columns stay.

    Null texts stay null; a text without lines left becomes empty; shorter lines are never touched. Null keys come before
    all others in the order of places. Rows that repeat key and text are the same place: they keep the same lines.
    """
    names = docs.columns
    clean = _cleaned(docs, edits, least, key, text, levels, "_op9_lines")
    return clean.withColumn(text, F.when(F.col(text).isNotNull(), F.array_join("_op9_lines", "\n"))).select(*names)


def report(docs: DataFrame, edits: int = 1, least: int = 20, key: str = "doc_id", text: str = "text", levels: int = 2) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_lines``, ``n_kept`` and ``kept_sha256`` of the text that is left.

    A null text has no lines and counts as empty.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    clean = _cleaned(own, edits, least, "key", "text", levels, "left")
    lines = lambda c: F.when(F.col("text").isNull(), 0).otherwise(c).cast("long")
    return clean.select(
        F.col("key").alias(key), lines(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).alias("n_lines"),
        lines(F.size("left")).alias("n_kept"), F.sha2(F.coalesce(F.array_join("left", "\n"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


REPORT_SQL = """
with d as (select doc_id, string_split(text, chr(10)) as l from documents
), t as (select doc_id, p, l[p] as line from (select doc_id, l, unnest(range(1, len(l) + 1)) as p from d)
), f as (select line, doc_id, p, length(line) as n from t where length(line) >= 20
         qualify row_number() over (partition by line order by doc_id, p) = 1
), near as (
  select b.doc_id, b.p, a.line as x, b.line as y, a.n as nx, b.n as ny
  from f a join f b on b.n in (a.n - 1, a.n, a.n + 1) and (b.doc_id, b.p) > (a.doc_id, a.p)
    and (left(a.line, 5) = left(b.line, 5) or right(a.line, 5) = right(b.line, 5))
), pre as (
  select *, coalesce(list_position(list_transform(range(1, least(nx, ny) + 1), lambda i: substr(x, i, 1) <> substr(y, i, 1)), true), least(nx, ny) + 1) as c from near
), late as (
  select distinct doc_id, p from pre where case when nx = ny then substr(x, c + 1) = substr(y, c + 1)
    when nx < ny then substr(x, c) = substr(y, c + 1) else substr(x, c + 1) = substr(y, c) end
), k as (
  select t.doc_id, count(*) as n_kept, string_agg(t.line, chr(10) order by t.p) as left_
  from t left join f on t.doc_id = f.doc_id and t.p = f.p left join late on t.doc_id = late.doc_id and t.p = late.p
  where length(t.line) < 20 or (f.p is not null and late.p is null) group by 1
)
select d.doc_id, coalesce(len(d.l), 0)::bigint as n_lines, coalesce(k.n_kept, 0)::bigint as n_kept, sha256(coalesce(k.left_, '')) as kept_sha256
from d left join k using (doc_id)
"""
