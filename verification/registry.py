"""Queries and the SQL they are checked against, registered together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import configure, cut_lineage, file_system, in_slice, in_slices
from verification import views

FLOAT = "float"  # compare rates of any size to float precision
# Queries that shuffle all lines several times work through them in slices of so many bytes of line files.
SLICE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Inputs:
    """Access to the tables and derived relations of one data folder."""

    spark: SparkSession
    folder: str
    built: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        return views.frame(self.spark, self.folder, name, self.built)

    def stored(self, name: str) -> DataFrame:
        """A relation written once, as the table it stands for would be, and then scanned."""
        key = f"{name} (stored)"
        if key not in self.built:
            self.built[key] = cut_lineage(getattr(self, name))
        return self.built[key]

    def with_frames(self, **frames: DataFrame) -> Inputs:
        """The same tables and relations, some of them replaced; relations made of these follow."""
        return Inputs(self.spark, self.folder, frames)

    def slices(self) -> int:
        """How many slices the lines are worked through in."""
        files, place = file_system(self.spark, f"{self.folder}/lineitem.parquet")
        return max(1, -(-files.getContentSummary(place).getLength() // SLICE_BYTES))

    def sliced(self, number: int, count: int, **keys: Column) -> Inputs:
        """Inputs with one slice of the rows of some tables, told by a key of each."""
        return self.with_frames(
            **{name: getattr(self, name).where(in_slice(key, number, count)) for name, key in keys.items()}
        )

    def stored_in_slices(self, name: str, unused: Sequence[str] = (), **keys: Column) -> DataFrame:
        """A relation without its unused columns, written once. It falls apart by the given keys of its tables, and so
        it is made slice by slice."""
        count = self.slices()

        def build(number: int) -> DataFrame:
            return getattr(self.sliced(number, count, **keys), name).drop(*unused)

        return in_slices(self.spark, count, build) if count > 1 else cut_lineage(build(0), "zstd")


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None = None
    digits: Mapping[str, int | str] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Inputs(configure(spark), folder))
        settled = {
            name: F.col(name).cast("float").cast("double")
            if digits == FLOAT
            else F.round(F.col(name), digits) + F.lit(0.0)  # no negative zero
            for name, digits in self.digits.items()
        }
        return df.withColumns(settled) if settled else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        text = views.with_clause(self.sql)
        if not self.digits:
            return text
        settled = ", ".join(
            f"cast(cast({name} as float) as double) as {name}"
            if digits == FLOAT
            else f"round({name}, {digits}) + 0.0 as {name}"
            for name, digits in self.digits.items()
        )
        return f"select * replace ({settled}) from (\n{text}\n) checked"


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, digits: Mapping[str, int | str] | None = None):
    """Register the decorated builder under ``name``."""

    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = Query(build, sql, digits or {})
        return build

    return add
