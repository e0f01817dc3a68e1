"""Quality rules whose limits follow the corpus: mergeable quantile sketches per language and source.

Each text gives six measures as whole numbers (shares per ten thousand, lengths per hundred). A sketch is a
histogram of them with buckets of five leading bits, so a quantile is right to one part in 32, sketches of two
sets merge by adding counts in any order, and a group of any size keeps at most about 900 buckets a measure.
Counts are summed on the map side. A group of fewer than ``least`` texts borrows the sketch of its language,
a small language that of the corpus.

The limits of a group are its quartiles widened by ``reach`` times their distance (at least the measure's own
``slack``); a text outside any limit is not kept. The base rule is fixed: fewer than 20 words, or more than 30 %
of the words in repeated windows.

Defined results: a null text has no words and fails the base rule; null languages and sources are groups of
their own; null doc_ids and repeated rows are judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, ready, shingles, stage, texts, word_hashes

WINDOW = 8
#: measure: smallest distance of the limits from the quartiles, in the measure's own unit
SLACK = {"symbols": 500, "dup_lines": 1000, "repeats": 1000, "upper": 1000, "marks": 1500, "length": 100}
SCHEMA = ("doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long")


def counts_of(text: bytes | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks."""
    if not text:
        return (0,) * 8
    words = word_hashes(text, lower=False)
    solid = text.translate(None, b" \t\n\x0b\x0c\r")
    data = np.frombuffer(solid, np.uint8)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= WINDOW:
        runs = shingles(words, WINDOW)
        _, where, often = np.unique(runs, return_inverse=True, return_counts=True)
        if len(often) < len(runs):
            edge = np.zeros(len(words) + 1, np.int64)
            starts = np.flatnonzero(often[where] > 1)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + WINDOW, -1)
            repeated = int(np.count_nonzero(np.cumsum(edge)[:-1]))
    return (len(words), int(np.count_nonzero((data & 0xC0) != 0x80)),
            len(solid) - len(solid.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated, len(lines),
            int(np.count_nonzero((data >= 65) & (data <= 90))), len(solid) - len(solid.translate(None, b"!?#*$%&|<>")))


def measured(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))

    def count(batches):
        for ids, langs, sources, found in texts(batches, "doc_id", "lang", "source", "text"):
            cols = list(zip(*map(counts_of, found))) or [()] * 8
            yield pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(x, pa.binary()).cast(pa.string()) for x in (langs, sources)),
                                   *(pa.array(c, pa.int64()) for c in cols)],
                                  [x.split()[0] for x in SCHEMA.split(", ")])

    return rows.mapInArrow(count, SCHEMA)


def measures() -> dict:
    ratio = lambda a, b, by=10000: F.when(F.col(b) > 0, F.floor(F.col(a) * by / F.col(b))).otherwise(0).cast("long")
    return {"symbols": ratio("n_symbols", "n_words"), "dup_lines": ratio("n_dup_lines", "n_lines"),
            "repeats": ratio("n_repeat_words", "n_words"), "upper": ratio("n_upper", "word_chars"),
            "marks": ratio("n_marks", "n_words"), "length": ratio("word_chars", "n_words", 100)}


def limits(rows: DataFrame, reach: int = 6, least: int = 200) -> DataFrame:
    """(lang_key, source_key, low, high): maps from measure to limit, for every group of ``rows``."""
    long = rows.select("lang_key", "source_key", F.explode(F.create_map(
        *[x for m in SLACK for x in (F.lit(m), F.col(m))])).alias("measure", "value"))
    bits = F.greatest(F.length(F.bin("value")) - 5, F.lit(0))
    sketch = stage(long.withColumn("bucket", F.call_function("shiftleft", F.call_function("shiftright", "value", bits), bits))
                   .groupBy("lang_key", "source_key", "measure", "bucket").agg(F.count("*").alias("n")), "sketch")
    found = None
    for level in (["lang_key", "source_key"], ["lang_key"], []):
        merged = sketch.groupBy(*level, "measure", "bucket").agg(F.sum("n").alias("n"))
        by = Window.partitionBy(*level, "measure")
        upto = merged.withColumns({"upto": F.sum("n").over(by.orderBy("bucket")), "all": F.sum("n").over(by)})
        at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bucket")))
        q = upto.groupBy(*level, "measure").agg(F.max("all").alias("rows"), at(1).alias("q1"), at(3).alias("q3"))
        slack = F.element_at(F.create_map(*[x for m, s in SLACK.items() for x in (F.lit(m), F.lit(s))]), F.col("measure"))
        wide = F.greatest(reach * (F.col("q3") - F.col("q1")), slack)
        pairs = F.sort_array(F.collect_list(F.struct("measure", (F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high"))))
        found_here = q.groupBy(*level).agg(F.max("rows").alias(f"rows{len(level)}"), pairs.alias(f"limits{len(level)}"))
        found = found_here if found is None else (
            found.join(found_here, level) if level else found.join(found_here.withColumn("one", F.lit(1)),
                                                                   F.lit(1) == F.col("one")).drop("one"))
    own = F.when(F.col("rows2") >= least, F.col("limits2")).when(F.col("rows1") >= least, F.col("limits1")).otherwise(F.col("limits0"))
    return stage(found.select("lang_key", "source_key", own.alias("limits")), "limits")


def judged(rows: DataFrame, **how) -> DataFrame:
    """``rows`` of counts with base_failed and kept."""
    key = lambda c: F.coalesce(F.concat(F.lit("s"), c), F.lit("n"))
    rows = rows.withColumns({"lang_key": key(F.col("lang")), "source_key": key(F.col("source")), **measures()})
    found = limits(rows, **how)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    value = F.create_map(*[x for m in SLACK for x in (F.lit(m), F.col(m))])
    inside = F.forall("limits", lambda x: (F.element_at(value, x["measure"]) <= x["high"])
                      & (F.element_at(value, x["measure"]) >= x["low"]))
    return rows.join(found, ["lang_key", "source_key"]).withColumns({"base_failed": base, "kept": ~base & inside})


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    rows = stage(measured(documents(spark, sf_dir)), "counts")
    return judged(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")


_RATIO = "case when {b} > 0 then floor({a} * {by} / {b}) else 0 end::bigint as {m}"
_MEASURES = ", ".join(_RATIO.format(a=a, b=b, by=by, m=m) for m, a, b, by in (
    ("symbols", "n_symbols", "n_words", 10000), ("dup_lines", "n_dup_lines", "n_lines", 10000),
    ("repeats", "n_repeat_words", "n_words", 10000), ("upper", "n_upper", "word_chars", 10000),
    ("marks", "n_marks", "n_words", 10000), ("length", "word_chars", "n_words", 100)))
_SLACKS = ", ".join(f"('{m}', {s})" for m, s in SLACK.items())
_LEVEL = """
u{n} as (select {keys} measure, bucket, sum(sum(n)) over (partition by {keys} measure order by bucket) as upto,
                sum(sum(n)) over (partition by {keys} measure) as total
         from sketch group by {keys} measure, bucket),
q{n} as (select {keys} measure, max(total) as held, min(case when upto * 4 >= total then bucket end) as q1,
                min(case when upto * 4 >= total * 3 then bucket end) as q3
         from u{n} group by {keys} measure)"""
OP9_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(lang, chr(1)) as lang, coalesce(source, chr(1)) as source,
         coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
w as (select r, i, array_to_string(words[i:i + 7], ' ') as run
      from (select r, words, unnest(range(1, len(words) - 6)) as i from d where len(words) >= 8)),
often as (select r, run from w group by r, run having count(*) > 1),
covered as (select r, count(distinct i + k) as n_repeat_words
            from (select w.r, w.i, unnest(range(0, 8)) as k from w join often using (r, run)) group by r),
lines as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
          from (select r, unnest(string_split(text, chr(10))) as line from d)
          where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
c as (
  select d.*, len(words)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         coalesce(n_lines, 0)::bigint as n_lines, len(regexp_extract_all(text, '[A-Z]'))::bigint as n_upper,
         len(regexp_extract_all(text, '[!?#*$%&|<>]'))::bigint as n_marks
  from d left join lines using (r) left join covered using (r)),
m as (select *, """ + _MEASURES + r""" from c),
long as (unpivot (select r, lang, source, symbols, dup_lines, repeats, upper, marks, length from m)
         on symbols, dup_lines, repeats, upper, marks, length into name measure value value),
sketch as (
  select lang, source, measure, (value >> b) << b as bucket, count(*) as n
  from (select *, greatest(length(bin(value)) - 5, 0)::bigint as b from long) group by all),""" + ",".join(
    _LEVEL.format(n=n, keys=k) for n, k in ((2, "lang, source,"), (1, "lang,"), (0, ""))) + r""",
slack as (select * from (values """ + _SLACKS + r""") t(measure, slack)),
q as (
  select a.lang, a.source, a.measure,
         case when a.held >= 200 then a.q1 when b.held >= 200 then b.q1 else z.q1 end as q1,
         case when a.held >= 200 then a.q3 when b.held >= 200 then b.q3 else z.q3 end as q3
  from q2 a join q1 b using (lang, measure) join q0 z using (measure)),
outside as (
  select distinct r from long join q using (lang, source, measure) join slack using (measure)
  where value > q3 + greatest(6 * (q3 - q1), slack) or value < q1 - greatest(6 * (q3 - q1), slack))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and outside.r is null as kept
from m left join outside using (r)
"""

QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES = {"op9_quality_rules": OP9_SQL}
