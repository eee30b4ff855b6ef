"""Tab-separated table dumps without header or quotes; an empty field is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_LINES = 1_000_000  # a record of more lines is not gathered

# The columns of each dump, in file order, as the files hold them.
DUMPS = {
    "AWBuildVersion": (
        "system_info_id int, database_version string, version_date timestamp, "
        "modified_date timestamp"
    ),
    "AddressType": "address_type_id int, name string, rowguid string, modified_date timestamp",
    "ContactType": "contact_type_id int, name string, modified_date timestamp",
    "Culture": "culture_id string, name string, modified_date timestamp",
    "Currency": "currency_code string, name string, modified_date timestamp",
    "Department": "department_id int, name string, group_name string, modified_date timestamp",
    "EmployeeDepartmentHistory": (
        "employee_id int, department_id int, shift_id int, start_date date, end_date date, "
        "modified_date timestamp"
    ),
    "EmployeePayHistory": (
        "employee_id int, rate_change_date timestamp, rate decimal(19,4), pay_frequency int, "
        "modified_date timestamp"
    ),
    "Location": (
        "location_id int, name string, cost_rate decimal(10,4), availability decimal(8,2), "
        "modified_date timestamp"
    ),
    "ProductCategory": (
        "product_category_id int, name string, rowguid string, modified_date timestamp"
    ),
    "ProductCostHistory": (
        "product_id int, start_date timestamp, end_date timestamp, "
        "standard_cost decimal(19,4), modified_date timestamp"
    ),
    "ProductDocument": "product_id int, document_node string, modified_date timestamp",
    "ProductListPriceHistory": (
        "product_id int, start_date timestamp, end_date timestamp, list_price decimal(19,4), "
        "modified_date timestamp"
    ),
    "ProductModelIllustration": (
        "product_model_id int, illustration_id int, modified_date timestamp"
    ),
    "ProductModelProductDescriptionCulture": (
        "product_model_id int, description_id int, culture_id string, modified_date timestamp"
    ),
    "ProductProductPhoto": (
        "product_id int, photo_id int, is_primary boolean, modified_date timestamp"
    ),
    "ProductReview": (
        "review_id int, product_id int, reviewer string, review_date timestamp, email string, "
        "rating int, comments string, modified_date timestamp"
    ),
    "ProductSubcategory": (
        "product_subcategory_id int, product_category_id int, name string, rowguid string, "
        "modified_date timestamp"
    ),
    "SalesPerson": (
        "person_id int, territory_id int, quota decimal(19,4), bonus decimal(19,4), "
        "commission decimal(10,4), sales_ytd decimal(19,4), sales_last_year decimal(19,4), "
        "rowguid string, modified_date timestamp"
    ),
    "SalesPersonQuotaHistory": (
        "person_id int, quota_date timestamp, quota decimal(19,4), rowguid string, "
        "modified_date timestamp"
    ),
    "SalesReason": (
        "sales_reason_id int, name string, reason_type string, modified_date timestamp"
    ),
    "SalesTaxRate": (
        "tax_rate_id int, state_province_id int, tax_type int, tax_rate decimal(10,4), "
        "name string, rowguid string, modified_date timestamp"
    ),
    "SalesTerritory": (
        "territory_id int, name string, country_code string, territory_group string, "
        "sales_ytd decimal(19,4), sales_last_year decimal(19,4), cost_ytd decimal(19,4), "
        "cost_last_year decimal(19,4), rowguid string, modified_date timestamp"
    ),
    "SalesTerritoryHistory": (
        "person_id int, territory_id int, start_date timestamp, end_date timestamp, "
        "rowguid string, modified_date timestamp"
    ),
    "ScrapReason": "scrap_reason_id int, name string, modified_date timestamp",
    "Shift": (
        "shift_id int, name string, start_time string, end_time string, modified_date timestamp"
    ),
    "ShipMethod": (
        "ship_method_id int, name string, ship_base decimal(19,4), ship_rate decimal(19,4), "
        "rowguid string, modified_date timestamp"
    ),
    "ShoppingCartItem": (
        "item_id int, cart_id string, quantity int, product_id int, date_created timestamp, "
        "modified_date timestamp"
    ),
    "SpecialOffer": (
        "offer_id int, description string, discount_pct decimal(10,4), offer_type string, "
        "category string, start_date timestamp, end_date timestamp, min_qty int, max_qty int, "
        "rowguid string, modified_date timestamp"
    ),
    "UnitMeasure": "unit_code string, name string, modified_date timestamp",
    "Vendor": (
        "vendor_id int, account_number string, name string, credit_rating int, "
        "preferred boolean, active boolean, web_url string, modified_date timestamp"
    ),
}
# Text padded with blanks to a fixed width, cut before it is compared.
PADDED = {
    "Culture": ["culture_id"],
    "ProductModelProductDescriptionCulture": ["culture_id"],
    "UnitMeasure": ["unit_code"],
}
# Dumps whose records span lines, with the pattern that starts a record.
MULTI_LINE = {"ProductReview": r"^\d+\t\d+\t"}


def parse_records(
    texts: DataFrame, schema: T.StructType, free_tail: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``texts(text)``, one record each, as typed rows and as rejects (text, reason).

    A record must have as many fields as ``schema``; with ``free_tail`` the last one is free text
    and keeps its tabs. An empty field is null. A field that is not of its type, or a wrong number
    of fields, sends the record to the rejects, nothing is cut. Fractions of a second
    beyond micros are cut; 0 and 1 become booleans. Padded with blanks, numbers and dates are read."""
    n = len(schema.fields)
    fields = F.split("text", "\t", n if free_tail else -1)

    def value(i: int) -> Column:
        return F.when(fields[i] != "", fields[i])

    def typed(i: int, field: T.StructField) -> Column:
        text = value(i)
        if isinstance(field.dataType, T.BooleanType):
            text = text.try_cast("int")
        return text.try_cast(field.dataType)

    reason = F.when(F.size(fields) != n, F.concat(F.size(fields).cast("string"), F.lit(" fields")))
    for i, field in enumerate(schema.fields):
        unfit = value(i).isNotNull() & typed(i, field).isNull()
        reason = reason.when(unfit, F.lit(f"{field.name} is not {field.dataType.simpleString()}"))
    marked = texts.withColumn("reason", reason)
    rows = marked.where("reason IS NULL").select(
        *[typed(i, field).alias(field.name) for i, field in enumerate(schema.fields)]
    )
    return rows, marked.where("reason IS NOT NULL").select("text", "reason")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, free_tail: bool = False):
    """One record per line, see ``parse_records``; a large file is read by many tasks."""
    return tsv_records(spark, path, schema, free_tail)[0]


def tsv_records(
    spark: SparkSession, path: str, schema: T.StructType, free_tail: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of a file of lines."""
    lines = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "text")
    return parse_records(lines, schema, free_tail)


def read_records(
    spark: SparkSession, path: str, start: str, schema: T.StructType, free_tail: bool = False
) -> DataFrame:
    """Typed rows of ``span_records``, of records of any number of lines: nothing here would
    tell of those that are left out."""
    return span_records(spark, path, start, schema, free_tail, whole=True)[0]


def span_records(
    spark: SparkSession, path: str, start: str, schema: T.StructType, free_tail: bool = False,
    whole: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of records that span lines: one starts at each line that matches
    ``start``.

    Large files stay split. Each split counts its record starts; the starts in earlier splits
    of the file are added, so the lines at the head of a split join the record they belong to.
    Lines before the first start of a file are not part of any record: they are rejects, line by
    line. So are the lines of a record of more than RECORD_LINES lines, which no task gathers; with
    ``whole`` it is a record like others, its lines joined by split, then its splits in order."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_line"),
            "value",
            F.col("value").rlike(start).cast("int").alias("_start"),
        )
    )
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = (
        lines.groupBy("_file", "_split")
        .agg(F.sum("_start").alias("_starts"))
        .select(
            "_file",
            "_split",
            F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    within = Window.partitionBy("_file", "_split").orderBy("_line")
    numbered = lines.withColumn("_number", F.sum("_start").over(within)).join(
        splits, ["_file", "_split"]
    )
    record = F.col("_number") + F.col("_before")
    parts = F.array_sort(F.collect_list(F.struct("_split", "_line", "value")))
    numbered = numbered.withColumn("_record", record)
    sizes = numbered.groupBy("_file", "_record").agg(F.count("*").alias("_n"))
    large = sizes.where(F.col("_n") > RECORD_LINES).select("_file", "_record")
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    gathered = numbered.where(record > 0)
    if whole:
        gathered = gathered.groupBy("_file", "_record", "_split").agg(
            F.min("_line").alias("_line"), joined.alias("value")
        )
    else:
        gathered = gathered.join(large, ["_file", "_record"], "left_anti")
    texts = gathered.groupBy("_file", "_record").agg(joined.alias("text"))
    rows, rejects = parse_records(texts.select("text"), schema, free_tail)
    loose = numbered.where(record == 0).select(
        F.col("value").alias("text"), F.lit("before the first record").alias("reason")
    )
    if whole:
        return rows, rejects.unionByName(loose)
    endless = numbered.where(record > 0).join(large, ["_file", "_record"], "left_semi").select(
        F.col("value").alias("text"), F.lit("in a record of too many lines").alias("reason")
    )
    return rows, rejects.unionByName(loose).unionByName(endless)


def read_dump(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of ``DUMPS`` from ``folder``, typed, padding cut."""
    schema = T.StructType.fromDDL(DUMPS[name])
    path = f"{folder}/{name}.csv"
    if name in MULTI_LINE:
        df = read_records(spark, path, MULTI_LINE[name], schema)
    else:
        df = read_tsv(spark, path, schema)
    return df.withColumns({c: F.rtrim(c) for c in PADDED.get(name, [])})
