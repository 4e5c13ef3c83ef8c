"""The ingest gate with keyed state: what a micro-batch costs follows the batch, not its history.

Each key's occupied intervals live in the state store, in cells of time.  A
micro-batch's rows of a key are taken in their order; a row reads the cells it touches,
and no others, so earlier batches are never read again.  A row is
admitted when it overlaps no admitted row of its key, stored ones included: a
row that clashes only with a refused row is admitted, as by a row-at-a-time
trigger.

A key's rows of one micro-batch are handled together, as in any stateful
operator, so the source's limit on a batch bounds a task; whole tables go
through ``wardline.operators.acceptance``, which cuts keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from wardline.functions.calendar import epoch_micros
from wardline.operators.acceptance import Cover
from wardline.session import materialise, ship

START, END, FOUND = "__wl_s", "__wl_e", "__wl_rules"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FAR = 32  # cells of an interval that is kept apart instead of in each of its cells
APART = -(1 << 62)  # number of the cell of such intervals


class Occupied(StatefulProcessor):
    """Admits a key's rows in order against the occupied intervals that the state holds.

    State: cell number -> starts and ends of the covered time in it, as sorted
    lists.  An interval stands in every cell it touches; one that touches over
    ``FAR`` cells stands in one cell of its own kind, which every row reads.
    """

    def __init__(self, key: str, order: str, cell: int, rule: str, columns: Sequence[str]) -> None:
        self.key, self.order, self.cell, self.rule, self.columns = key, order, cell, rule, list(columns)

    def init(self, handle) -> None:
        self.cells = handle.getMapState("occupied", "cell long", "starts array<long>, ends array<long>")

    def close(self) -> None:
        pass

    def _cover(self, loaded: dict[int, Cover], cell: int) -> Cover:
        if cell not in loaded:
            cover = Cover()
            held = self.cells.getValue((cell,))
            if held is not None:
                cover.starts, cover.ends = list(held[0]), list(held[1])
            loaded[cell] = cover
        return loaded[cell]

    def _touched(self, s: int, e: int) -> range:
        return range(s // self.cell, max(s, e - 1) // self.cell + 1)

    def _meets(self, loaded: dict[int, Cover], s: int, e: int) -> bool:
        touched = self._touched(s, e)
        if len(touched) > FAR:  # rare: look through all of the key's cells
            for (cell,) in list(self.cells.keys()):
                self._cover(loaded, cell)
            return any(cover.meets(s, e) for cover in loaded.values())
        # an empty interval between two cells may lie inside one that only the cell before holds
        near = [touched[0] - 1, *touched] if s == e and s % self.cell == 0 else touched
        return self._cover(loaded, APART).meets(s, e) or any(self._cover(loaded, c).meets(s, e) for c in near)

    def _occupy(self, loaded: dict[int, Cover], changed: set[int], s: int, e: int) -> None:
        touched = self._touched(s, e)
        for cell in touched if len(touched) <= FAR else [APART]:
            self._cover(loaded, cell).add(s, e)
            changed.add(cell)

    def _keep(self, loaded: dict[int, Cover], changed: set[int]) -> None:
        for cell in changed:
            self.cells.updateValue((cell,), (loaded[cell].starts, loaded[cell].ends))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        loaded: dict[int, Cover] = {}
        changed: set[int] = set()
        rows = [initialState] if isinstance(initialState, Row) else initialState
        for row in rows:
            for s, e in zip(row["starts"], row["ends"], strict=True):
                self._occupy(loaded, changed, s, e)
        self._keep(loaded, changed)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        loaded: dict[int, Cover] = {}
        changed: set[int] = set()
        for row in sorted(rows, key=lambda r: r[self.order]):
            s, e, found = row[START], row[END], list(row[FOUND])
            if key[0] is not None and s is not None and e is not None and s <= e:
                if self._meets(loaded, s, e):
                    found.append(self.rule)
                elif not found:
                    self._occupy(loaded, changed, s, e)
            yield Row(**{c: row[c] for c in self.columns}, **{FOUND: found})
        self._keep(loaded, changed)


def admitted(
    stream: DataFrame,
    stored: DataFrame,
    key: str,
    order: str,
    start: str,
    end: str,
    *,
    static: dict[str, Column] | None = None,
    rule: str = "overlaps",
    cell_seconds: int = 86_400,
) -> DataFrame:
    """The rows of a stream plus ``FOUND``, the rules that refuse each (an empty list: admitted).

    ``static`` maps rules to conditions on the row itself (or on static tables
    joined to the stream) under which it is refused; a refused row
    occupies nothing.  ``stored`` rows (``key, start, end``) are admitted from the start
    (the state's first content).  ``order`` is a column that isn't null: rows of a
    micro-batch are taken in its order.  A row with a null key or time meets nothing.
    """
    ship(stream.sparkSession)
    found = [F.when(cond, F.lit(name)) for name, cond in (static or {}).items()]
    found = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    rows = stream.withColumn(START, epoch_micros(start)).withColumn(END, epoch_micros(end)).withColumn(FOUND, found)
    out = T.StructType([*stream.schema.fields, T.StructField(FOUND, T.ArrayType(T.StringType()))])
    first = stored.select(key, epoch_micros(start).alias("s"), epoch_micros(end).alias("e")).where(F.col(key).isNotNull() & (F.col("s") <= F.col("e")))
    # a row per key and cell, so that a long history is no single row
    first = first.groupBy(key, F.floor(F.col("s") / (cell_seconds * 1_000_000))).agg(F.collect_list("s").alias("starts"), F.collect_list("e").alias("ends"))
    first = first.select(key, "starts", "ends")
    return rows.groupBy(key).transformWithState(
        Occupied(key, order, cell_seconds * 1_000_000, rule, stream.columns),
        outputStructType=out,
        outputMode="Append",
        timeMode="None",
        initialState=first.groupBy(key),
    )


def run_keyed_gate(checked: DataFrame, out_dir: str, *, checkpoint_location: str, key: Sequence[str]) -> StreamingQuery:
    """Write the rows that ``admitted`` gives: ``out_dir/accepted`` as they came, ``out_dir/rejected`` as ``key`` and ``rule``.

    Each batch overwrites ``batch_id=N`` of both, so a replayed batch rewrites
    the same files; nothing of earlier batches is read.  Processes what is
    available, then stops.  The state is kept in RocksDB, as map states need it;
    the session's own choice of a store for other streams stays.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = materialise(batch)
        accepted = batch.where(F.size(FOUND) == 0).drop(FOUND)
        rejected = batch.select(*key, F.explode(FOUND).alias("rule"))
        accepted.write.mode("overwrite").parquet(f"{out_dir}/accepted/batch_id={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{out_dir}/rejected/batch_id={batch_id}")

    conf = checked.sparkSession.conf
    was = conf.get(STORE, None)
    conf.set(STORE, ROCKSDB)  # a stream keeps the settings that it starts with
    try:
        return checked.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    finally:
        conf.unset(STORE) if was is None else conf.set(STORE, was)
