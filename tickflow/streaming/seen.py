"""The alerts that were shown, by day, in a few folders however many refreshes there were.

Every refresh writes what it shows for the first time to folders ``day=D/upto=N`` and says in a
manifest which folders count. Like digits of a binary counter, a refresh takes in the youngest
folders of a day that stand for no more refreshes than itself, so a day has about as many folders
as its number of refreshes has binary digits, and a row is written again as rarely.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow import schemas
from tickflow.streaming import manifest
from tickflow.streaming.manifest import Entry

SHOWN, COUNTS, GONE = "shown", "counts", "gone"
COUNT = T.StructType([T.StructField(name, T.LongType()) for name in ("batch_id", "records", "new_alerts")])
MOST_DAYS = 366
"""Days of a refresh's alerts up to which only theirs are read of what was shown; beyond, all are."""
_KEY = list(schemas.RESULT_KEY)


def _absorbed(folders: list[Entry]) -> tuple[list[Entry], list[Entry]]:
    """(folders that stay, folders that a new one of weight 1 takes in), oldest first."""
    kept, weight = list(folders), 1
    taken: list[Entry] = []
    while kept and kept[-1].weight <= weight:
        weight += kept[-1].weight
        taken.append(kept.pop())
    return kept, taken


class SeenStore:
    """What ``start_new_alerts`` keeps below ``path``; ``layout`` are the columns of its alerts."""

    def __init__(self, spark: SparkSession, path: str, layout: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.layout = T.StructType([*layout.fields, T.StructField("batch_id", T.LongType())])

    def _folder(self, entry: Entry) -> str:
        return f"{self.path}/{entry.item}"

    def _read(self, entries: list[Entry], layout: T.StructType) -> DataFrame:
        return manifest.read_folders(self.spark, map(self._folder, entries), layout)

    def _load(self, before: int | None = None) -> tuple[int, list[Entry]]:
        return manifest.load(self.spark, f"{self.path}/manifest", before)

    def folders(self, kind: str = SHOWN) -> list[str]:
        """The folders that a reader lists."""
        return [self._folder(entry) for entry in self._load()[1] if entry.kind == kind]

    def shown(self) -> DataFrame:
        return self._read([e for e in self._load()[1] if e.kind == SHOWN], self.layout)

    def counts(self) -> DataFrame:
        return self._read([e for e in self._load()[1] if e.kind == COUNTS], COUNT)

    def show(self, batch: DataFrame, batch_id: int) -> None:
        """Write the alerts of a refresh that no earlier one showed, and how many came and are new.

        Both numbers are observed by the write itself, after the last exchange, where a lost task
        that is run again does not count twice. Running a refresh again replaces it.
        """
        _, entries = self._load(before=batch_id)
        for entry in entries:
            if entry.kind == GONE:
                manifest.remove(self.spark, self._folder(entry))
        dated = batch.withColumn("day", F.to_date("window_end"))
        days = [row[0] for row in dated.select("day").distinct().limit(MOST_DAYS + 1).collect()]
        names = {manifest.day_name(day) for day in days}
        live = [e for e in entries if e.kind == SHOWN]
        near = live if len(days) > MOST_DAYS else [e for e in live if e.day in names]
        first, found, written = self._new(dated, self._read(near, self.layout))
        # Folders that are taken in are written again, with what is new for their day.
        by_day = {day: _absorbed([e for e in near if e.day == day]) for day in {e.day for e in near}}
        taken = [e for _, gone in by_day.values() for e in gone]
        again = self._read(taken, self.layout).withColumn("day", F.to_date("window_end"))
        rows = found.withColumn("batch_id", F.lit(batch_id)).select(*first, "batch_id", "day")
        rows = rows.unionByName(again.select(*rows.columns)) if taken else rows
        target = rows.withColumn("upto", F.lit(batch_id)).repartition("day") if taken else rows.withColumn("upto", F.lit(batch_id))
        writer = target.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "upto").parquet(f"{self.path}/{SHOWN}")
        seen = written.get
        fresh = set(seen.get("days") or []) | {e.day for e in taken}
        kept = [e for e in live if e not in taken]
        kept += [
            Entry(SHOWN, day, f"{SHOWN}/day={day}/upto={batch_id}", 1 + sum(e.weight for e in taken if e.day == day))
            for day in sorted(fresh)
        ]
        numbers = batch_id, seen.get("records") or 0, seen.get("new_alerts") or 0
        counted, dropped = self._count([e for e in entries if e.kind == COUNTS], *numbers)
        gone = [Entry(GONE, e.day, e.item) for e in (*taken, *dropped)]
        manifest.save(self.spark, f"{self.path}/manifest", batch_id, [*kept, *counted, *gone])

    def _new(self, dated: DataFrame, earlier: DataFrame) -> tuple[list[str], DataFrame, Observation]:
        """(columns, each alert once that is not among the earlier ones, what is observed)."""
        columns = [name for name in dated.columns if name != "day"]
        others = [F.first(name).alias(name) for name in dated.columns if name not in _KEY]
        once = dated.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("deliveries"), *others)
        known = earlier.select(*(F.col(name).alias(f"seen_{name}") for name in _KEY), F.lit(True).alias("seen"))
        same = [F.col(name).eqNullSafe(F.col(f"seen_{name}")) for name in _KEY]
        joined = once.join(known, reduce(lambda a, b: a & b, same), "left")
        observation, is_new = Observation(), F.col("seen").isNull()
        observed = joined.observe(
            observation,
            F.sum("deliveries").alias("records"),
            F.count_if(is_new).alias("new_alerts"),
            F.collect_set(F.when(is_new, manifest.day_folder())).alias("days"),
        )
        return columns, observed.filter(is_new), observation

    def _count(self, live: list[Entry], *numbers: int) -> tuple[list[Entry], list[Entry]]:
        """Write a refresh's numbers: (folders of numbers that count now, those that no longer do)."""
        kept, taken = _absorbed(live)
        rows = self.spark.createDataFrame([numbers], COUNT)
        rows = rows.unionByName(self._read(taken, COUNT)) if taken else rows
        item = f"{COUNTS}/upto={numbers[0]}"
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{item}")
        return [*kept, Entry(COUNTS, None, item, 1 + sum(e.weight for e in taken))], taken
