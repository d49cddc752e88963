"""Build (and optionally materialise) the three layers for one input folder.

``layers(spark, sf_dir)`` returns bronze / silver / gold DataFrames.  A table
is materialised once per session and input folder, when it is first asked for
-- written as Parquet below the checkpoint folder and read back -- the way a
warehouse serves its layers from stored tables instead of recomputing views.
What a query does not read is not built for it; a query that reads a table
once takes its ``view``, which is computed in the same pass unless it is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from layerforge.plans.gold import build_gold, dim_customers, dim_products, fact_sales
from layerforge.plans.silver import (
    build_silver, passthrough, silver_customers, silver_demographics, silver_locations, silver_products, silver_sales,
)
from layerforge.session import write_through
from layerforge.sources.standins import BRONZE_BUILDERS, bronze_tables
from layerforge.sources.versions import folder_state


@dataclass
class Layers:
    bronze: Mapping[str, DataFrame]
    silver: Mapping[str, DataFrame]
    gold: Mapping[str, DataFrame]

    def store_all(self) -> Layers:
        """Every table of the three layers stored."""
        for layer in (self.bronze, self.silver, self.gold):
            layer.values()
        return self


class Tables(Mapping):
    """The tables of one layer, each stored once, when it is first asked for; all of them are stored at once."""

    def __init__(self, layer: str, builders: Mapping[str, Callable[[], DataFrame]]):
        self._layer, self._builders, self._stored = layer, builders, {}
        self._locks = {name: Lock() for name in builders}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._stored:
                self._stored[name] = materialize(self._builders[name](), f"{self._layer}-{name}")
            return self._stored[name]

    def view(self, name: str) -> DataFrame:
        """The table as it is stored, or else its plan, for a reader that goes over it once."""
        return self._stored[name] if name in self._stored else self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def items(self):
        return run_parallel({name: (lambda n=name: self[n]) for name in self}).items()

    def values(self):
        return dict(self.items()).values()


_CACHE: dict[tuple, Layers] = {}
T = TypeVar("T")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` below the shared checkpoint folder and read it back (see ``write_through``)."""
    return write_through(df, name)


# Fixed value: independent table writes submitted at once (the declared parallel jobs).
PARALLEL_WRITES = 4


def run_parallel(tasks: dict[str, Callable[[], T]], workers: int = PARALLEL_WRITES) -> dict[str, T]:
    """Run independent Spark actions from a few driver threads; results by name.

    Each thread submits its own job; the cluster scheduler interleaves them, so
    the fixed per-job latency of many small tables overlaps instead of adding up.
    """
    if len(tasks) <= 1 or workers <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def materialize_all(frames: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    return run_parallel({k: (lambda v=v, k=k: materialize(v, f"{prefix}-{k}")) for k, v in frames.items()})


def build_layers(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                 store: bool = True) -> Layers:
    """Bronze, silver and gold; with ``store`` every table is written once and read back.

    Storing each layer is what the warehouse does: later steps (checks,
    reports, the next layer) read stored tables with file statistics instead
    of recomputing the derivation chain from the raw feeds.  Tables of one
    layer do not depend on each other and are written concurrently.
    """
    bronze = bronze_tables(spark, sf_dir)
    if store:
        bronze = materialize_all(bronze, "bronze")
    silver = build_silver(bronze, as_of)
    if store:
        silver = materialize_all(silver, "silver")
    if not store:
        return Layers(bronze, silver, build_gold(silver))
    dims = run_parallel({
        "dim_customers": lambda: materialize(
            dim_customers(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"]),
            "gold-dim_customers"),
        "dim_products": lambda: materialize(
            dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"]), "gold-dim_products"),
    })
    dc, dp = dims["dim_customers"], dims["dim_products"]
    fs = materialize(fact_sales(silver["crm_sales_details"], dp, dc), "gold-fact_sales")
    return Layers(bronze, silver, {"dim_customers": dc, "dim_products": dp, "fact_sales": fs})


#: Reference date of the registered queries, which must give the same rows on any day.
QUERY_AS_OF = "2001-01-01"


def _state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input tables, so that new data under one path is built anew; no Spark job."""
    return tuple(sorted(folder_state(spark, sf_dir)))


def lazy_layers(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> Layers:
    """The tables of ``build_layers``, each built when it is asked for.

    Silver is computed from bronze, and the fact from silver, in one pass unless those are stored; the sales feed and
    both dimensions are stored (the rules of feed, silver and fact in one plan were slower than the write they save).
    """
    bronze = Tables("bronze", {name: (lambda f=fn: f(spark, sf_dir)) for name, fn in BRONZE_BUILDERS.items()})
    of = bronze.view
    silver = Tables("silver", {
        "crm_cust_info": lambda: silver_customers(of("crm_cust_info")),
        "crm_prd_info": lambda: silver_products(of("crm_prd_info")),
        "crm_sales_details": lambda: silver_sales(bronze["crm_sales_details"]),
        "erp_cust_az12": lambda: silver_demographics(of("erp_cust_az12"), as_of),
        "erp_loc_a101": lambda: silver_locations(of("erp_loc_a101")),
        "erp_px_cat_g1v2": lambda: passthrough(of("erp_px_cat_g1v2")),
    })
    def cleaned(*names: str) -> list[DataFrame]:
        return list(run_parallel({name: (lambda n=name: silver[n]) for name in names}).values())

    def fact() -> DataFrame:
        parts = run_parallel({"sales": lambda: silver.view("crm_sales_details"), "products": lambda: gold["dim_products"],
                              "customers": lambda: gold["dim_customers"]})
        return fact_sales(parts["sales"], parts["products"], parts["customers"])

    gold = Tables("gold", {
        "dim_customers": lambda: dim_customers(*cleaned("crm_cust_info", "erp_cust_az12", "erp_loc_a101")),
        "dim_products": lambda: dim_products(*cleaned("crm_prd_info", "erp_px_cat_g1v2")),
        "fact_sales": fact,
    })
    return Layers(bronze, silver, gold)


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Memoised per (application, folder, state of its files): a table is built and stored once, when it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), *_state_of(spark, sf_dir))
    if key not in _CACHE:
        _CACHE[key] = lazy_layers(spark, sf_dir, QUERY_AS_OF)
    return _CACHE[key]


def reset_cache() -> None:
    _CACHE.clear()
