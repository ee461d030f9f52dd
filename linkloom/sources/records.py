"""Record, truth and id-list files: tab-separated with a header, read by position."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECORD = ["entity_id", "name", "address", "country"]


def _table(spark: SparkSession, path: str, names: list[str], multi_line: bool = False, placed: bool = False) -> DataFrame:
    """Columns by position whatever the header says; short rows are padded, more columns ignored, blank lines skipped.
    Files are split among tasks; ``multi_line`` allows quoted line breaks, at the price of one task a file. ``placed`` adds
    ``at``, which orders rows by file name and by place in the file."""
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.schema(schema).csv(path, sep="\t", header=True, enforceSchema=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE")
    at = [F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("at")] if placed else []
    return rows.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names], *at)


def read_records(spark: SparkSession, path: str, countries: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Records with empty strings for what is missing; the country filter reaches the scan."""
    rows = _table(spark, path, RECORD, multi_line)
    return rows.where(F.col("country").isin(countries)) if countries is not None else rows


def read_ground_truth(spark: SparkSession, path: str, placed: bool = False) -> DataFrame:
    """(s1_id, ids); no second column is no match, and empty ids go."""
    rows = _table(spark, path, ["s1_id", "list"], placed=placed).where("s1_id != '' or list != ''")
    return rows.select("s1_id", F.filter(F.split("list", ","), lambda x: x != "").alias("ids"), *(["at"] if placed else []))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the one of greatest ``order``."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Truth with one row for each record; of repeated ones the last stands: in the last file by name, at the last place."""
    return last_wins(read_ground_truth(spark, path, placed=True), "s1_id", "at").drop("at")


def list_countries(records: DataFrame) -> DataFrame:
    return records.select("country").distinct()


def truth_edges(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", F.explode(F.array_distinct("ids")).alias("cand_id"))


def write_id_lists(rows: DataFrame, path: str, header: tuple[str, str]) -> int:
    """(id, ids) as two columns, each list without repeats, in order. Returns the rows written."""
    out = rows.select(F.col(rows.columns[0]).alias(header[0]), F.array_join(F.array_distinct(rows.columns[1]), ",").alias(header[1]))
    seen = Observation()
    out.observe(seen, F.count("*").alias("n")).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="")
    return seen.get["n"]


def every_record(s1: DataFrame, lists: DataFrame) -> DataFrame:
    """A row for each source-1 record, with an empty list where ``lists`` (s1_id, ids) has none."""
    return s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").select("s1_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def validate(matches: DataFrame, cands: DataFrame, s1: DataFrame) -> DataFrame:
    """(rule, violations) of a run's two outputs (s1_id, ids)."""
    pairs = lambda d: d.select("s1_id", F.explode("ids").alias("c"))
    counts = {
        "a row for each record": s1.select(F.col("entity_id").alias("s1_id")).join(matches, "s1_id", "left_anti"),
        "no other rows": matches.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_anti"),
        "no repeats in a list": matches.where(F.size(F.array_distinct("ids")) < F.size("ids")),
        "matches are candidates": pairs(matches).join(pairs(cands), ["s1_id", "c"], "left_anti"),
        "a candidate matches once": pairs(matches).groupBy("c").count().where("count > 1"),
    }
    out = None
    for rule, bad in counts.items():
        row = bad.agg(F.lit(rule).alias("rule"), F.count("*").alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


@dataclass(frozen=True)
class Catalog:
    """Where a data set's files are; ``LINKLOOM_DATA`` moves the folder."""

    root: str = os.environ.get("LINKLOOM_DATA", "data")
    split: str = "train"

    def path(self, what: str) -> str:
        return f"{self.root}/{self.split}/{self.split}_{what}.tsv"

    def sources(self, spark: SparkSession, countries: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """Source 1, and the pool of sources 2 and 3."""
        one, two, three = (read_records(spark, self.path(f"source{k}"), countries) for k in (1, 2, 3))
        return one, two.unionByName(three)
