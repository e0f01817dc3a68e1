"""Streams with state of our own per key: totals that close after a silence, and first arrivals that correct themselves.

Both hand out changed rows; readers put them together, so the result is that of a batch over the same
rows, whatever order the files come in. No row is dropped: what comes after its key was given up, or has
no time, goes to an output of its own. Where keys live as long as the load, rows are first put together where they
are read, so a hot key is a few rows, and a state holds a map of many keys. Keys with a lifetime have timers and a
state each; a key is spread over ``slots`` states by a hash, so a hot key is not one task, and the reader adds the
slots up. Times are whole microseconds and amounts whole units, which makes every sum exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from sparkloom.operators.groups import top_rows, units
from sparkloom.streaming import micro_batches as M

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ASIDE = "kind IN ('late', 'undated')"
SLOTS = 256  # states that share the keys of a load without lifetime
FIGURES = ["born", "first", "last", "n", "known", "units", "top"]


def _frame(key: tuple, names: list[str], rows: list[tuple], whole: list[str]) -> pd.DataFrame:
    """Output rows of one key; whole numbers keep their nulls."""
    out = pd.DataFrame([(*key, *row) for row in rows], columns=names, dtype=object)
    return out.astype({c: "Int64" for c in whole})


def _both(held: tuple, fresh: tuple) -> tuple:
    """Two pieces of a key's totals as one."""
    pick = lambda how, a, b: b if a is None else a if b is None else how(a, b)
    return (held[0], pick(min, held[1], fresh[1]), pick(max, held[2], fresh[2]), held[3] + fresh[3], held[4] + fresh[4],
            pick(int.__add__, held[5], fresh[5]), pick(max, held[6], fresh[6]))


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Totals of the rows of each key in a batch."""
    for rows in batches:
        known = rows["has"] == 1
        time, amount = rows["us"].astype("Int64").where(rows["dated"]), rows["amount"].astype("Int64").where(known)
        rows = rows.assign(first=time, last=time, n=1, known=rows["has"], units=amount, top=amount)
        out = rows.groupby(["who", "slot"], as_index=False, sort=False).agg({"first": "min", "last": "max", "n": "sum", "known": "sum", "top": "max"})
        units = rows.groupby(["who", "slot"], as_index=False, sort=False)["units"].sum(min_count=1)
        yield out.assign(born=out["first"], units=units["units"])[["who", "slot", *FIGURES]]


def _earliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Earliest time of each key and item in a batch."""
    for rows in batches:
        yield rows.groupby(["who", "slot", "named", "item"], as_index=False, sort=False)["us"].min()[list(rows.columns)]


class _Sums(StatefulProcessor):
    """Running rows of the keys of a slot, in a map that lies in the state store; they are never closed."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.state = handle.getMapState("totals", "who string", ", ".join(f"{c} bigint" for c in FIGURES))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[str, tuple] = {}
        for part in rows:
            figures = zip(*([None if pd.isna(v) else int(v) for v in part[c]] for c in FIGURES))
            for who, piece in zip(part["who"], figures):
                fresh[who] = _both(fresh[who], piece) if who in fresh else piece
        out = []
        for who, piece in fresh.items():
            held = _both(tuple(self.state.getValue((who,))), piece) if self.state.containsKey((who,)) else (piece[1], *piece[1:])
            self.state.updateValue((who,), held)
            out.append((who, *key, "open", *held))
        if out:
            yield _frame((), self.names, out, ["slot", *FIGURES])

    def close(self) -> None:
        pass


class _Totals(StatefulProcessor):
    """One running row per key, which is closed once the watermark has passed its newest row."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("totals", ", ".join(f"{c} bigint" for c in FIGURES))

    def _out(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        return _frame(key, self.names, rows, FIGURES)

    def _aside(self, key: tuple, kind: str, part: pd.DataFrame) -> pd.DataFrame:
        """One output row per late or undated row."""
        known = part["has"] == 1
        time = part["us"].astype("Int64").where(part["dated"])
        amount = part["amount"].astype("Int64").where(known)
        out = pd.DataFrame({"born": pd.NA, "first": time, "last": time, "n": 1, "known": part["has"], "units": amount, "top": amount},
                           index=part.index).astype("Int64")
        for place, (name, value) in enumerate(zip(self.names, (*key, kind))):
            out.insert(place, name, value)
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self.state.get() if self.state.exists() else None
        before = held
        for part in rows:
            undated, late = ~part["dated"], part["dated"] & (part["us"] < mark)
            for kind, some in (("undated", part[undated]), ("late", part[late])):
                if len(some):
                    yield self._aside(key, kind, some)
            part = part[~undated & ~late]
            if held is not None and len(part) and held[2] < mark:  # silent for too long: its timer has not run yet
                yield self._out(key, [("closed", *held)])
                self.handle.deleteTimer(held[2] // 1000 + 1)
                held = before = None
            if len(part):
                held = self._add(held, part)
        if held is not None and held != before:
            if before is None or before[2] != held[2]:
                if before is not None:
                    self.handle.deleteTimer(before[2] // 1000 + 1)
                self.handle.registerTimer(held[2] // 1000 + 1)
            self.state.update(tuple(held))
            yield self._out(key, [("open", *held)])

    @staticmethod
    def _add(held: tuple | None, part: pd.DataFrame) -> tuple:
        dated, known = part.loc[part["dated"], "us"], part.loc[part["has"] == 1, "amount"]
        first, last = (int(dated.min()), int(dated.max())) if len(dated) else (None, None)
        fresh = (first, first, last, len(part), len(known), sum(known.tolist()) if len(known) else None,
                 int(known.max()) if len(known) else None)
        if held is None:
            return fresh
        return _both(held, fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        if held is not None and held[2] < timerValues.getCurrentWatermarkInMs() * 1000:
            self.state.clear()
            yield self._out(key, [("closed", *held)])

    def close(self) -> None:
        pass


class _First(StatefulProcessor):
    """Earliest time of each key and item of a slot, in a map that lies in the state store."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "who string, named boolean, item string", "us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best: dict[tuple, int] = {}
        for part in rows:
            for who, named, item, us in zip(part["who"], part["named"].tolist(), part["item"], part["us"].tolist()):
                best[who, named, item] = min(us, best.get((who, named, item), us))
        out = []
        for entry, us in best.items():
            if not self.seen.containsKey(entry) or us < self.seen.getValue(entry)[0]:
                self.seen.updateValue(entry, (us,))
                out.append((entry[0], *key, entry[2] if entry[1] else None, us))
        if out:
            yield _frame((), self.names, out, ["slot", "us"])

    def close(self) -> None:
        pass


def _fields(*names: str) -> T.StructType:
    out = T.StructType([])
    for name in ("who", "slot", *names):
        out = out.add(name, T.StringType() if name in ("who", "kind", "item") else T.LongType())
    return out


def _who(*keys: str) -> Column:
    """The key as one text that is never null, since pandas would turn null numbers into others."""
    return F.to_json(F.struct(*keys))


def _keys(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The columns of the key again; ``keys`` gives their types."""
    schema = ", ".join(f"`{k}` {t}" for k, t in keys.items())
    return df.withColumn("_k", F.from_json("who", schema)).select(*[F.col("_k")[k].alias(k) for k in keys], *df.columns).drop("who")


def _slot(slots: int, *by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(slots))


def keyed_totals(stream: DataFrame, keys: list[str], ts: str, amount: str, scale: int = 2, lifetime: str | None = None,
                 slots: int | None = None) -> DataFrame:
    """Changes of the totals of each key: rows, sum and largest amount, first and last time.

    ``lifetime`` bounds the state: a key without a row for so long, measured by the newest time of earlier
    micro-batches, is handed out as ``closed`` and forgotten, and begins anew with its next row. Rows older
    than that come out as ``late``, rows without a time as ``undated``, one each. Without it a key lives
    as long as the load and every row counts. Null amounts are counted as rows, not in the sum; null keys
    are a key. ``slots``: states of a key with a lifetime (8), or else states that all keys share (``SLOTS``).
    """
    names = ["kind", *FIGURES]
    time = F.col(ts).cast("timestamp")
    rows = stream
    if lifetime:  # the mark lies on a copy, so that Spark moves it but drops no row
        rows = rows.withColumn("_mark", time).withWatermark("_mark", lifetime).drop("_mark")
    slot = _slot(slots or 8, *stream.columns) if lifetime else _slot(slots or SLOTS, *keys)
    rows = rows.select(_who(*keys).alias("who"), slot.alias("slot"), time.isNotNull().alias("dated"),
                       F.coalesce(F.unix_micros(time), F.lit(0)).alias("us"), F.col(amount).isNotNull().cast("int").alias("has"),
                       F.coalesce(units(amount, scale), F.lit(0)).alias("amount"))
    schema = _fields(*names)
    if lifetime:
        return rows.groupBy("who", "slot").transformWithStateInPandas(_Totals(schema.fieldNames()), schema, "update", "EventTime")
    pieces = rows.mapInPandas(_pieces, _fields(*FIGURES))
    return pieces.groupBy("slot").transformWithStateInPandas(_Sums(schema.fieldNames()), schema, "update", "None")


def keyed_first(stream: DataFrame, key: str, item: str, ts: str, slots: int = SLOTS) -> DataFrame:
    """Changes of the earliest time of each item (as text) of a key; rows without a time are left out.

    An item that comes again with an earlier time is handed out again. An item of a key lies in one slot.
    """
    time = F.col(ts).cast("timestamp")
    rows = stream.filter(time.isNotNull()).select(
        _who(key).alias("who"), _slot(slots, key, item).alias("slot"), F.unix_micros(time).alias("us"),
        F.col(item).isNotNull().alias("named"), F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"))
    schema = _fields("item", "us")
    return rows.mapInPandas(_earliest, rows.schema).groupBy("slot").transformWithStateInPandas(
        _First(schema.fieldNames()), schema, "update", "None")


def load(changes: DataFrame, folder: str) -> DataFrame:
    """Process all that is there and return every change so far; a later call with the same folder goes on."""
    spark = changes.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # the only store with timers and maps
    try:
        path = M.run(changes, "keyed", "update", folder)
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    return read(spark, path, changes.schema)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return M.read_batches(spark, path, M._with_batch(schema))


def _moment(us: str) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def totals_of(changes: DataFrame, keys: dict[str, str], scale: int = 2, aside: bool = False) -> DataFrame:
    """One row per key: the newest state of every piece, added up; ``aside`` adds late and undated rows too.

    ``keys`` names the columns of the key with their types.
    """
    held = changes.filter(F.col("kind").isin("open", "closed"))
    pieces = top_rows(held, ["who", "slot", "born"], [F.desc("batch"), F.desc("n")])
    if aside:
        pieces = pieces.unionByName(changes.filter(ASIDE))
    amount = lambda c: c / 10 ** scale
    return _keys(pieces.groupBy("who").agg(
        F.sum("n").alias("n"), amount(F.sum("units")).alias("total"), amount(F.max("top")).alias("top"),
        _moment(F.min("first")).alias("first_ts"), _moment(F.max("last")).alias("last_ts")), keys)


def aside_of(changes: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The second output: late rows and rows without a time."""
    return _keys(changes.filter(ASIDE), keys)


def first_of(changes: DataFrame, keys: dict[str, str]) -> DataFrame:
    return _keys(changes.groupBy("who", "item").agg(_moment(F.min("us")).alias("first_ts")), keys)
