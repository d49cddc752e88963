"""The six raw feeds as CSV files: headers checked, typed load, bad lines kept aside.

A feed folder holds one file (or folder of part files) per feed, named as in ``FEED_FILES``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge import schemas as SCH
from layerforge.sources import files as FS

# Where each feed lies in a feed folder, and the two groups with their members' names.
FEED_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}
FEED_GROUPS = {
    "crm": {"customers": "crm_cust_info", "products": "crm_prd_info", "sales": "crm_sales_details"},
    "erp": {"customers": "erp_cust_az12", "locations": "erp_loc_a101", "categories": "erp_px_cat_g1v2"},
}


@dataclass
class Feed:
    """Typed rows of a feed, and the lines (as text) that do not fit its schema."""

    rows: DataFrame
    rejected: DataFrame


def feed_paths(folder: str) -> dict[str, str]:
    return {name: f"{folder.rstrip('/')}/{file}" for name, file in FEED_FILES.items()}


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """Column names in a file's first line; None when there is no such file."""
    if not FS.exists(spark, path):
        return None
    return spark.read.option("header", "true").csv(path).columns


def check_feeds(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(file, found, column_count, missing, extra, ok) from the headers of the files themselves.

    Names are compared without case.  ``ok`` also asks for the declared order: the load is positional.
    """
    rows = []
    for name, path in paths.items():
        have = header_of(spark, path)
        want = [c.lower() for c in SCH.EXPECTED_COLUMNS[name]]
        low = [c.lower() for c in have or []]
        rows.append((name, have is not None, len(low), ",".join(sorted(set(want) - set(low))),
                     ",".join(sorted(set(low) - set(want))), low == want))
    return spark.createDataFrame(rows, "file string, found boolean, column_count int, missing string, extra string, ok boolean")


def load_feed(spark: SparkSession, name: str, path: str) -> Feed:
    """Typed rows and rejected lines of one feed; a header that differs from the declared one is an error."""
    have = header_of(spark, path)
    if have is None:
        raise FileNotFoundError(f"feed {name}: no file at {path}")
    if [c.lower() for c in have] != [c.lower() for c in SCH.EXPECTED_COLUMNS[name]]:
        raise ValueError(f"feed {name}: header {have} is not {SCH.EXPECTED_COLUMNS[name]}")
    read = FS.read_bronze_csv(spark, path, SCH.BRONZE[name], keep_corrupt=True)
    bad = F.col(FS.CORRUPT).isNotNull()
    # Spark refuses to read the mark of bad lines alone (as a count would), so a declared column is looked at as well.
    looked = F.length(F.coalesce(F.col(read.columns[0]).cast("string"), F.lit(""))) >= 0
    return Feed(read.where(~bad & looked).drop(FS.CORRUPT),
                read.where(bad & looked).select(F.lit(name).alias("feed"), F.col(FS.CORRUPT).alias("line")))


def load_feeds(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, Feed]:
    return {name: load_feed(spark, name, path) for name, path in paths.items()}


def load_group(spark: SparkSession, folder: str, group: str) -> dict[str, Feed | None]:
    """The feeds of a group by their member names; None for a file that is not there."""
    paths = feed_paths(folder)
    return {member: load_feed(spark, feed, paths[feed]) if header_of(spark, paths[feed]) is not None else None
            for member, feed in FEED_GROUPS[group].items()}


def write_feeds(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write bronze tables in the raw feed format; their paths."""
    paths = feed_paths(folder)
    for name, df in tables.items():
        FS.write_bronze_csv(df, paths[name])
    return {name: paths[name] for name in tables}


def read_text(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A feed with every field as the text in the file, for rules on what has not been typed yet."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in SCH.EXPECTED_COLUMNS[name]])
    return FS.read_bronze_csv(spark, path, schema)
