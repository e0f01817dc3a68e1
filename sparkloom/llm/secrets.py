"""Secret scan with a randomness test battery, in DataFrame functions only.

Base kinds are patterns (``assign``, ``access``, ``hex``). The method adds ``random``: runs of 20 or more letters
and digits that hold both are taken as written in the smallest of four encodings (16, 32, 36 or 64 symbols) and
tested for it: chi-squared uniformity of the alphabet (with the exact mean and variance of a uniform string of
that length), runs above and below the middle of the alphabet, and serial correlation of neighbours. Fisher's
method joins the three into one p-value, which is even between 0 and 1 for random strings and near 0 for words.

False discoveries are controlled by length: in each stratum (encoding, length class) the number of truly random
strings is read off the upper half of the p-values, and a string is reported if its p-value is above the
smallest limit (at least ``FLOOR``) at which the estimated share of other strings among the reported ones is at
most ``q``. Each distinct run counts once, since copies are no independent tests. A stratum of fewer than
``LEAST`` distinct runs takes the limit of its encoding, that of all runs if the encoding has too few as well,
and ``FLOOR`` where all runs together are too few. The histograms behind this hold at most 20 x 100 counters,
summed over all documents with partial sums.

Positions come from what lies between matches (``split``) and the matches themselves, as code points.

Defined results: a null text is empty; a text without spans has the hash of the empty string and empty
``spans``; null doc_ids and repeated rows are scanned row by row; an empty table gives no rows; other columns
are kept by ``redact`` and not read by ``scan``.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import documents, ready, stage

# fixed values: the patterns of the base kinds
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RUN = r"[A-Za-z0-9+/]{20,}"
KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<start:int,kind:int,end:int>>"

ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuvwxyz",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
LENGTHS = (24, 32, 48, 64)  # classes: below 24, below 32, ...
BINS = 100
LEAST = 100  # distinct runs that a histogram needs to give a limit
FLOOR = 1e-4  # runs less likely than this are not random, whatever their stratum


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, step) -> Column:
    """0 and then the folds of all values before each one, by ``step(sofar, value)``, which must be associative.

    Values are cut into about sqrt(n) chunks: chunks are folded, then their folds, then the values of each chunk
    from its own start, so a list of n takes n * sqrt(n) copies and not n * n.
    """
    def prefixes(part: Column, start: Column) -> Column:
        return F.aggregate(part, F.array(start), lambda a, x: F.concat(a, F.array(step(F.element_at(a, -1), x))))

    def chunks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / width).cast("int") - 1, F.lit(0))),
                           lambda i: F.slice(v, i * width + 1, width))

    def inside(cut: Column) -> Column:
        folds = F.transform(cut, lambda part: F.aggregate(part, F.lit(0), step))
        return let(prefixes(folds, F.lit(0)), lambda starts: F.flatten(F.transform(cut, lambda part, i: let(
            prefixes(part, F.element_at(starts, i + 1)), lambda a: F.slice(a, F.lit(1), F.size(a) - 1)))))

    return let(let(values, chunks), inside)


def running_sums(values: Column) -> Column:
    """Sums of all values before each one."""
    return running(values, lambda a, x: a + x)


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the matches (leftmost, non-overlapping) whose ``group`` has ``least`` or more characters."""
    def spans(x: Column) -> Column:
        steps = F.zip_with(x["gaps"], x["hits"], lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))
        begins = running_sums(steps)
        rows = F.arrays_zip(begins.alias("begin"), x["gaps"].alias("gap"), x["hits"].alias("hit"), x["values"].alias("value"))
        rows = F.filter(rows, lambda r: r["hit"].isNotNull() & (F.length(r["value"]) >= least))
        return F.transform(rows, lambda r: F.struct(
            (r["begin"] + F.length(r["gap"])).alias("start"), F.lit(kind).alias("kind"),
            (r["begin"] + F.length(r["gap"]) + F.length(r["hit"])).alias("end"), r["hit"].alias("hit")))

    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,hit:string>>")
    return F.when(text.rlike(pattern), let(found, spans)).otherwise(none)


def upper_tail(z: Column) -> Column:
    """Chance of a standard normal value above z (rational approximation, error below 1e-7)."""
    def tail(x: Column) -> Column:
        t = x["t"]
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.struct(x["z"].alias("z"), (F.exp(-x["z"] * x["z"] / 2) * 0.3989422804014327 * poly).alias("p"))

    steps = let(let(z, lambda v: F.struct(v.alias("z"), (1.0 / (F.abs(v) * 0.2316419 + 1.0)).alias("t"))), tail)
    return let(steps, lambda x: F.greatest(F.when(x["z"] < 0, 1 - x["p"]).otherwise(x["p"]), F.lit(1e-300)))


def tested(hit: Column) -> Column:
    """struct(encoding, hit) of a run; null for runs that are all letters or all digits."""
    encoding = (F.when(hit.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 0).when(hit.rlike("^[A-Z2-7]+$"), 1)
                .when(hit.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), 2).otherwise(3))
    mixed = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")
    return F.when(mixed, F.struct(encoding.alias("encoding"), hit.alias("hit")))


def battery(encoding: Column, hit: Column) -> Column:
    """p-value of the three tests for one run."""
    alphabet = F.element_at(F.array(*map(F.lit, ALPHABETS)), encoding + 1)
    folded = F.when((encoding == 0) | (encoding == 2), F.lower(hit)).otherwise(hit)
    places = let(alphabet, lambda a: F.struct(
        F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), lambda c: F.call_function("instr", a, c) - 1).alias("x"),
        F.length(a).cast("double").alias("k")))
    tails = let(let(let(places, _sums), _scores), lambda z: F.struct(
        upper_tail(z["chi"]).alias("chi"), F.least(2 * upper_tail(z["runs"]), F.lit(1.0)).alias("runs"),
        F.least(2 * upper_tail(z["lag"]), F.lit(1.0)).alias("lag")))
    half = let(tails, lambda p: -(F.log(p["chi"]) + F.log(p["runs"]) + F.log(p["lag"])))
    return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def _pairs(f, a: Column) -> Column:
    return F.zip_with(F.slice(a, F.lit(1), F.size(a) - 1), F.slice(a, F.lit(2), F.size(a) - 1), f)


def _sums(run: Column) -> Column:
    """What the tests need to know of a run: length, alphabet, sums of squares, runs, sums of neighbours."""
    x, k = run["x"], run["k"]
    total = lambda a, zero: F.aggregate(a, zero, lambda s, v: s + v)
    high = F.transform(x, lambda v: (v >= k / 2).cast("int"))
    squares = F.transform(F.array_distinct(x), lambda v: F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
    middle = total(x, F.lit(0)).cast("double") / F.size(x)
    return let(middle, lambda m: F.struct(
        F.size(x).cast("double").alias("n"), k.alias("k"), total(squares, F.lit(0.0)).alias("squares"),
        total(high, F.lit(0)).cast("double").alias("ones"),
        total(_pairs(lambda a, b: ((a >= k / 2) != (b >= k / 2)).cast("int"), x), F.lit(1)).alias("runs"),
        total(F.transform(x, lambda v: (v - m) * (v - m)), F.lit(0.0)).alias("spread"),
        total(_pairs(lambda a, b: (a - m) * (b - m), x), F.lit(0.0)).alias("lag")))


def _scores(s: Column) -> Column:
    """Normal scores of the three tests."""
    n, k = s["n"], s["k"]
    chi = (k / n * s["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    mean = 2 * s["ones"] * (n - s["ones"]) / n + 1
    runs = let(mean, lambda m: F.when((m - 1) * (m - 2) <= 0, F.lit(9.0)).otherwise(
        F.abs(s["runs"] - m) / F.sqrt(F.greatest((m - 1) * (m - 2), F.lit(1e-9)) / (n - 1))))
    lag = F.when(s["spread"] <= 0, F.lit(9.0)).otherwise(
        F.abs(s["lag"] / F.greatest(s["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n))
    return F.struct(chi.alias("chi"), runs.alias("runs"), lag.alias("lag"))


def length_class(n: Column) -> Column:
    return sum(((n >= x).cast("int") for x in LENGTHS), F.lit(0))


def found_spans(text: Column) -> dict[str, Column]:
    """base: spans of the base kinds; runs: (start, kind, end, stratum, p, run) of the tested runs, run a hash."""
    text = F.coalesce(text, F.lit(""))
    base = [matches(text, ASSIGN, 1, 2, 8), matches(text, ACCESS, 2), matches(text, HEX, 3)]
    trim = lambda a: F.transform(a, lambda x: F.struct(x["start"], x["kind"], x["end"]))
    runs = F.transform(matches(text, RUN, 4), lambda x: F.struct(
        x["start"], x["kind"], x["end"], tested(x["hit"]).alias("t")))
    runs = F.transform(F.filter(runs, lambda x: x["t"].isNotNull()), lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
        (x["t"]["encoding"] * (len(LENGTHS) + 1) + length_class(x["end"] - x["start"])).alias("stratum"),
        battery(x["t"]["encoding"], x["t"]["hit"]).alias("p"), F.xxhash64(x["t"]["hit"]).alias("run")))
    return {"base": F.array_sort(F.concat(*map(trim, base))), "runs": runs}


def limit_of(counts: dict[int, int], q: float) -> float | None:
    """Smallest p-value to report by a histogram of distinct runs; none if no bin is good enough."""
    random = 2 * sum(n for b, n in counts.items() if b >= BINS // 2)
    above, best = 0, None
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if random > 0 and above - random * (1 - b / BINS) <= q * above:
            best = max(b / BINS, FLOOR)
    return best


def limits(runs: DataFrame, q: float = 0.05) -> dict[int, float]:
    """Smallest p-value to report, per stratum (at most 20); strata without a limit report nothing."""
    each = runs.select(F.explode("runs").alias("r")).where(F.col("r.p") >= FLOOR).select(
        F.col("r.run").alias("run"), F.col("r.stratum").alias("stratum"),
        F.least(F.floor(F.col("r.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
    counts = each.distinct().groupBy("stratum", "bin").agg(F.count("*").alias("n")).collect()  # at most 20 x 100 rows
    levels = lambda s: (("stratum", s), ("encoding", s // (len(LENGTHS) + 1)), ("all",))
    held = defaultdict(Counter)
    for stratum, b, n in counts:
        for level in levels(stratum):
            held[level][b] += n
    out = {}
    for stratum in {r[0] for r in counts}:
        enough = next((held[x] for x in levels(stratum) if held[x].total() >= LEAST), None)
        out[stratum] = FLOOR if enough is None else limit_of(enough, q)
    return {k: v for k, v in out.items() if v is not None}


def reported(limit: dict[int, float], base: Column, runs: Column) -> Column:
    """All spans by start and kind."""
    cut = F.create_map(*[F.lit(x) for pair in sorted(limit.items()) for x in pair]) if limit else None
    keep = F.array().cast(SPANS) if cut is None else F.transform(
        F.filter(runs, lambda r: F.coalesce(r["p"] >= F.element_at(cut, r["stratum"]), F.lit(False))),
        lambda r: F.struct(r["start"], r["kind"], r["end"]))
    return F.array_sort(F.concat(base, keep))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, q: float = 0.05) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                             *(c.alias(n) for n, c in found_spans(F.col("text").cast("string")).items())), "spans")
    limit = limits(rows, q)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return rows.select("doc_id", count(1).alias("n_assign"), count(2).alias("n_access"), count(3).alias("n_hex"),
                       F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(reported(limit, F.col("base"), F.col("runs"))).alias("spans"))


def cut_out(text: Column, spans: Column, mark: str) -> Column:
    """The text with ``mark`` in place of each group of overlapping spans.

    A span that begins before an earlier one ends adds no gap; what is left are the gaps between, joined by marks.
    Gaps are cut by place from four bytes a character, where a cut costs its own length and not its distance from
    the start of the text.
    """
    def kept(x: Column) -> Column:
        ends = running(F.transform(x["spans"], lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        gaps = F.zip_with(x["spans"], ends, lambda s, at: F.struct(at.alias("at"), s["start"].alias("to")))
        last = F.struct(F.array_max(F.transform(x["spans"], lambda s: s["end"])).alias("at"), x["size"].alias("to"))
        gaps = F.concat(F.filter(gaps, lambda g: g["to"] >= g["at"]), F.array(last))
        return F.array_join(F.transform(gaps, lambda g: F.decode(
            F.substring(x["wide"], g["at"] * 4 + 1, (g["to"] - g["at"]) * 4), "UTF-32")), mark)

    parts = F.struct(spans.alias("spans"), F.encode(text, "UTF-32").alias("wide"), F.length(text).alias("size"))
    return let(parts, kept)


def redact(docs: DataFrame, q: float = 0.05, mark: str = "[secret]") -> DataFrame:
    """Every row, with its secrets replaced; texts without secrets stay as they are."""
    spans = found_spans(F.col("text").cast("string"))
    limit = limits(stage(docs.select(spans["runs"].alias("runs")).where(F.size("runs") > 0), "runs"), q)
    found = let(F.struct(spans["base"].alias("base"), spans["runs"].alias("runs")),
                lambda x: reported(limit, x["base"], x["runs"]))
    text = F.col("text")
    clean = let(found, lambda x: F.when(F.size(x) > 0, cut_out(text, x, mark)).otherwise(text))
    if "n_chars" not in docs.columns:
        return docs.withColumn("text", clean)
    both = let(clean, lambda t: F.struct(t.alias("text"), F.when(t.eqNullSafe(text), F.col("n_chars")).otherwise(
        F.length(t)).alias("n_chars")))
    return docs.withColumn("__new", both).withColumns({"text": F.col("__new.text"), "n_chars": F.col("__new.n_chars").cast(
        docs.schema["n_chars"].dataType)}).select(*docs.columns)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return redact(docs)


QUERIES = {"op4_secrets": op4_secrets}
ORACLES: dict[str, str] = {}
