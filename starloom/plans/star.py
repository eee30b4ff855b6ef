"""From source tables to a loaded star with its reports."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.marts import largest_first, revenue_by
from starloom.operators.shape import conform
from starloom.plans.dims import (
    dim_customer_narrow,
    dim_customer_wide,
    dim_date_narrow,
    dim_date_wide,
    dim_geography_narrow,
    dim_geography_wide,
    dim_product_narrow,
    dim_product_wide,
)
from starloom.plans.facts import LINE_KEYS, fact_narrow, fact_wide
from starloom.plans.increments import KeptReports
from starloom.plans.rejects import rejected_lines
from starloom.plans.schemas import DIMENSIONS, FACT, PRIMARY_KEYS, table_schema
from starloom.sinks.atomic import Load
from starloom.sinks.keymap import KeyMap
from starloom.sinks.star import Sink, load_star
from starloom.staging import settle

Source = Callable[[str], DataFrame]


def staged(source: Source) -> Source:
    """Reads each table once, into the shared folder, however often it is asked for; different
    tables at the same time. Use it over a database, which else would be read by every job."""
    tables: dict[str, DataFrame] = {}
    locks: dict[str, Lock] = defaultdict(Lock)

    def read(name: str) -> DataFrame:
        with locks[name]:
            if name not in tables:
                tables[name] = settle(source(name), name)
            return tables[name]

    return read


def build_dimensions(
    source: Source,
    model: str,
    ids: str = "int",
    fiscal_start_month: int = 1,
    held: Mapping[str, DataFrame | None] | None = None,
) -> dict[str, DataFrame]:
    """The four dimensions, each computed and written once. The narrow ones still hold their
    natural keys. ``held`` maps dimensions to the keys earlier loads gave; those stay."""
    held = held or {}
    kept = {name: {"held": held.get(name)} for name in DIMENSIONS}
    customer, person = source("Customer"), source("Person")
    goods = (source("Product"), source("ProductSubcategory"), source("ProductCategory"))
    places = (source("Address"), source("StateProvince"), source("CountryRegion"))
    header = source("SalesOrderHeader")
    if model == "wide":
        builders = {
            "DimCustomer": lambda: dim_customer_wide(
                customer, person, source("PersonPhone"), ids, **kept["DimCustomer"]
            ),
            "DimProduct": lambda: dim_product_wide(
                *goods, ids, **kept["DimProduct"]
            ),
            "DimGeography": lambda: dim_geography_wide(
                *places, ids, **kept["DimGeography"]
            ),
            "DimDate": lambda: dim_date_wide(
                header, source("SalesOrderDetail"), fiscal_start_month
            ),
        }
    else:
        builders = {
            "DimCustomer": lambda: dim_customer_narrow(
                customer, person, source("EmailAddress"), ids, **kept["DimCustomer"]
            ),
            "DimProduct": lambda: dim_product_narrow(
                *goods, ids, **kept["DimProduct"]
            ),
            "DimGeography": lambda: dim_geography_narrow(
                *places, ids, **kept["DimGeography"]
            ),
            "DimDate": lambda: dim_date_narrow(header),
        }
    # The dimensions do not depend on each other: their jobs share the cluster.
    with_tags = inheritable_thread_target(header.sparkSession)
    with ThreadPoolExecutor(len(builders)) as pool:
        jobs = {
            name: pool.submit(with_tags(lambda n, b: settle(b(), n)), name, build)
            for name, build in builders.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def build_star(
    source: Source,
    model: str,
    ids: str = "int",
    geo_role: str | None = None,
    geo_join: str = "inner",
    fiscal_start_month: int = 1,
    hot_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Dimensions and fact by table name, in the columns of ``schemas``. The fact is a plan over
    the written dimensions, not yet run."""
    dims = build_dimensions(source, model, ids, fiscal_start_month)
    header, detail = source("SalesOrderHeader"), source("SalesOrderDetail")
    options = {"geo_join": geo_join, "ids": ids, "hot_rows": hot_rows}
    if model == "wide":
        fact = fact_wide(header, detail, dims, geo_role or "ship", **options)
    else:
        fact = fact_narrow(header, detail, dims, geo_role or "bill", **options)
    star = {name: conform(dims[name], table_schema(model, name, ids)) for name in DIMENSIONS}
    return {**star, FACT: fact}


def reports(star: Mapping[str, DataFrame], model: str) -> dict[str, DataFrame]:
    """Revenue by category, city and year, in the order in which they are published."""
    fact = star[FACT]
    if model == "wide":
        measure, category, year = "LineTotal", "ProductCategoryName", "CalendarYear"
    else:
        measure, category, year = "SalesAmount", "ProductCategory", "Year"

    def by(dim: str, key: str, attr: str) -> DataFrame:
        return revenue_by(fact, star[dim], key, [attr], measure)

    categories = by("DimProduct", "ProductKey", category)
    cities = by("DimGeography", "GeographyKey", "City")
    return {
        "revenue_by_category": largest_first(categories, "TotalRevenue"),
        "revenue_by_city": largest_first(cities, "TotalRevenue"),
        "revenue_by_year": by("DimDate", "DateKey", year).orderBy(year),
    }


# The natural key that a source row of each dimension has.
NATURAL_KEYS = {
    "DimCustomer": "CustomerID", "DimProduct": "ProductID", "DimGeography": "AddressID",
}


def line_columns(model: str) -> list[str]:
    """What tells which source lines are in the fact."""
    return LINE_KEYS if model == "wide" else [*LINE_KEYS, "LineHash"]


def _growing_star(
    source: Source, sink: Sink, keys: KeyMap, model: str, mode: str, ids: str
) -> dict[str, DataFrame]:
    """The star's tables with keys that stay from load to load; when appending, only the lines
    and dimension rows that are not there yet. New keys are on record before rows use them."""
    detail = whole = source("SalesOrderDetail")
    spark = detail.sparkSession
    append = mode == "append"
    held = {name: keys.read(spark, name) if append else None for name in NATURAL_KEYS}
    loaded = keys.read(spark, FACT) if append else None
    dims = build_dimensions(source, model, ids, held=held)
    for name, natural in NATURAL_KEYS.items():
        surrogate = dims[name].columns[0]
        # the wide model drops rows after numbering; their numbers are not on record
        given = dims[name].select(natural, surrogate)
        if held[name] is None:
            keys.write(name, given, "overwrite")
        else:
            fresh = given.join(held[name], surrogate, "left_anti").select(natural, surrogate)
            keys.write(name, fresh, "append")
    lines = line_columns(model)
    if model == "narrow":
        # this model keeps every line: of those with equal ids each is known by its own values
        detail = whole = detail.withColumn("LineHash", F.xxhash64(*detail.columns))
    if loaded is not None:
        detail = detail.join(loaded, lines, "left_anti").select(*detail.columns)
    header = source("SalesOrderHeader")
    if model == "wide":
        fact = fact_wide(header, detail, dims, ids=ids, whole=whole)
        if not hasattr(sink, "written"):
            fact = settle(fact, FACT)
    else:
        fact = settle(fact_narrow(header, detail, dims, ids=ids, extra=lines, whole=whole), FACT)
    star = {name: conform(dims[name], table_schema(model, name, ids)) for name in DIMENSIONS}
    star[FACT] = fact
    if append and (fresh_rows := getattr(sink, "new_rows", None)):
        first = any(h is None for h in held.values())
        if not first:
            for name in DIMENSIONS:
                star[name] = settle(fresh_rows(name, star[name], PRIMARY_KEYS[name]), name)
    return star


def run_warehouse(
    source: Source,
    sink: Sink,
    model: str,
    report_sink: Callable[[str, DataFrame], None] | None = None,
    mode: str = "overwrite",
    ids: str = "int",
    keys: KeyMap | None = None,
    reject_sink: Callable[[str, DataFrame], None] | None = None,
    kept: KeptReports | None = None,
) -> dict[str, DataFrame]:
    """Read, build, load, report; returns the star. The reports read what the sink has written
    where it can be read back; else the fact is staged, so that it is computed once.

    ``keys``, or else the sink's own key map, lets a star grow: appending gives known source rows
    the keys they had, new ones the next numbers, and loads each order line once, so that loading
    the same source again adds nothing. Attributes of known rows stay as first loaded; their
    versions are what ``operators.versions`` keeps. A load of an ``AtomicStore`` is published after its
    last table, with its key map, so that a run that dies leaves nothing behind; ``kept`` adds the
    sums of its lines to it, and the reports are then read from the sums of all loads.
    ``reject_sink`` gets, by table, the lines whose measures do not fit."""
    keys = keys or getattr(sink, "keys", None)
    keys = keys if isinstance(keys, KeyMap) else None
    if kept is not None and not isinstance(sink, Load):
        raise ValueError("kept reports need a load of an AtomicStore")
    if mode == "append" and keys is None:
        raise ValueError("appending needs a key map: rows would be loaded again under new keys")
    read_back = getattr(sink, "read", None)
    if keys is not None:
        star = _growing_star(source, sink, keys, model, mode, ids)
    else:
        star = build_star(source, model, ids)
        if read_back is None:
            star[FACT] = settle(star[FACT], FACT)
    lines = star[FACT]
    star[FACT] = conform(lines, table_schema(model, FACT, ids))
    load_star(star, sink, mode, getattr(sink, "keep_tables", False))
    if keys is not None:
        if model == "wide" and hasattr(sink, "written"):  # it has all columns of the lines
            lines = star[FACT] = sink.written(FACT, star[FACT].schema)
        # a line that is there twice is known twice: that costs less than a shuffle of all lines
        keys.write(FACT, lines.select(*line_columns(model)), mode)
    if kept is not None:
        kept.add(sink, star[FACT], mode)
    if publish := getattr(sink, "publish", None):
        publish()
    if reject_sink is not None:
        reject_sink(FACT, rejected_lines(source("SalesOrderDetail"), model, ids))
    if read_back is not None:
        star = {name: read_back(df.sparkSession, name) for name, df in star.items()}
    if report_sink is not None:
        spark = star[FACT].sparkSession
        found = kept.reports(sink.store, spark) if kept is not None else reports(star, model)
        for name, df in found.items():
            report_sink(name, df)
    return star
