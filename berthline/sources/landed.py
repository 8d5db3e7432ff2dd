"""Landed JSON: documents of unknown outer shape, feed pages, manifests, dashboard payloads.

A landed document is one text with one JSON value.  Records come out as one
VARIANT per row with their position, so that list order survives as a column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from berthline import fixed_values as fv
from berthline.functions.text import join_variant_names
from berthline.schemas import PAYLOAD_COLUMNS, PAYLOAD_TYPES, SEAT_COLUMNS
from berthline.session import list_names

_FALSY = ("null", "false", "0", '""', "{}", "[]")
_FILE_DATE = r"(\d{4}-\d{2}-\d{2})[^/]*$"


def landed_docs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, file_date, value): one row per landed file."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.to_date(F.nullif(F.regexp_extract("_metadata.file_name", _FILE_DATE, 1), F.lit(""))).alias(
            "file_date"
        ),
        "value",
    )


def _array_at(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _no_records() -> Column:
    return F.array().cast("array<variant>")


def _first_list_of_objects(text: Column) -> Column:
    """The first value, in document order, that is a list starting with an object."""
    values = F.from_json(text, "map<string,string>")
    lists = F.transform(
        F.json_object_keys(text), lambda key: _array_at(F.try_parse_json(values[key]), "$")
    )
    fitting = F.filter(lists, lambda a: (F.size(a) > 0) & _is_object(a[0]))
    return F.coalesce(F.try_element_at(fitting, F.lit(1)), _no_records())


def records_of(text: Column, doc: Column) -> Column:
    """The record array of a document: itself, its first non-empty known key, or its first list."""
    chain = F.when(_array_at(doc, "$").isNotNull(), _array_at(doc, "$"))
    for key in fv.DOCUMENT_KEYS:
        items = _array_at(doc, "$." + key)
        value = F.to_json(F.try_variant_get(doc, "$." + key, "variant"))
        filled = F.when(items.isNotNull(), F.size(items) > 0).otherwise(~value.isin(*_FALSY))
        chain = chain.when(filled, F.coalesce(items, _no_records()))
    return chain.otherwise(_first_list_of_objects(text))


def explode_landed(docs: DataFrame, value: str = "value") -> DataFrame:
    """One row per record: the other columns of ``docs``, ``pos`` and ``rec``."""
    rows = _every_record(docs, value)
    return rows.filter(_is_object(F.col("rec")))


def _every_record(docs: DataFrame, value: str) -> DataFrame:
    keep = [c for c in docs.columns if c != value]
    parsed = docs.withColumn("__doc", F.try_parse_json(value))
    records = records_of(F.col(value), F.col("__doc"))
    return parsed.select(*keep, F.posexplode(records).alias("pos", "rec"))


NO_JSON, NO_OBJECT = "no JSON", "record is no object"


def judged_records(docs: DataFrame, value: str = "value") -> DataFrame:
    """Every record once, parsed once: the other columns, ``pos``, ``rec``, ``reason`` and ``raw``.

    Good records have no reason.  A document that is no JSON is one row without position, a record that is no
    object keeps its place; both have their reason and their text in ``raw``.
    """
    keep = [c for c in docs.columns if c != value]
    parsed = docs.withColumn("__doc", F.try_parse_json(value))
    broken = F.col("__doc").isNull()
    entries = F.when(~broken, records_of(F.col(value), F.col("__doc")))
    text = F.when(broken, F.col(value)).alias("__text")
    # What is needed of the document is taken before it is exploded: no record drags its document along.
    flat = parsed.select(*keep, broken.alias("__broken"), text, entries.alias("__entries"))
    rows = flat.select(*keep, "__broken", "__text", F.posexplode_outer("__entries").alias("pos", "rec"))
    rows = rows.filter(F.col("__broken") | F.col("pos").isNotNull())
    good = F.coalesce(_is_object(F.col("rec")), F.lit(False))
    reason = F.when(F.col("__broken"), F.lit(NO_JSON)).when(~good, F.lit(NO_OBJECT))
    raw = F.when(F.col("__broken"), F.col("__text")).when(~good, F.to_json("rec"))
    return rows.select(*keep, "pos", F.when(good, F.col("rec")).alias("rec"), reason.alias("reason"), raw.alias("raw"))


def broken_docs(docs: DataFrame, value: str = "value") -> DataFrame:
    """Documents that are no JSON."""
    return docs.filter(F.try_parse_json(value).isNull())


def read_landed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return explode_landed(landed_docs(spark, path))


def take_apart(df: DataFrame, record: str) -> DataFrame:
    """Replace the variant ``rec`` by the struct ``r`` of its known fields, cast once per record.

    The cast sits in a generator, which filters are not pushed through: a
    filter on parsed fields would otherwise repeat the parsing for each of its
    mentions of a field.
    """
    fields = F.array(F.try_variant_get("rec", "$", record))
    return df.select(*[c for c in df.columns if c != "rec"], F.explode(fields).alias("r"))


_LISTS = ("fish_types", "fishing_methods")
_COUNTS = ("total_seats", "reserved_seats", "remain_seats")


def normalize_aliases(
    df: DataFrame, run_ts: Column, aliases: dict[str, list[str]] | None = None
) -> DataFrame:
    """Records to the 16 snapshot columns: per field the first alias that is not null.

    Each record is taken apart by one cast to a struct of all aliases.  Dates
    stay text, as landed.  Other columns of ``df`` are kept.
    """
    names = fv.FIELD_ALIASES if aliases is None else aliases
    kinds = {f: "variant" if f in _LISTS + _COUNTS else "string" for f in names}
    known = {alias: kinds[field] for field, options in names.items() for alias in options}
    record = ",".join(f"`{alias}`:{kind}" for alias, kind in known.items())
    keep = [c for c in df.columns if c != "rec"]
    r = F.col("r")

    def first(field: str) -> Column:
        return F.coalesce(*[r[alias] for alias in names[field]])

    def first_variant(field: str) -> Column:
        return F.coalesce(
            *[F.when(~F.is_variant_null(r[alias]), r[alias]) for alias in names[field]]
        )

    def value(field: str) -> Column:
        if field in _LISTS:
            return join_variant_names(first_variant(field))
        if field in _COUNTS:
            count = F.try_variant_get(first_variant(field), "$", "bigint")
            return F.coalesce(count, F.lit(0).cast("bigint"))
        if field == "price":
            return F.coalesce(F.nullif(first(field), F.lit("")), F.lit("0"))
        return F.coalesce(first(field), F.lit(""))

    rows = take_apart(df, f"struct<{record}>")
    fields = [f for f in SEAT_COLUMNS if f != "collected_at"]
    return rows.select(
        *keep, run_ts.alias("collected_at"), *[value(f).alias(f) for f in fields]
    )


# --- feed pages -----------------------------------------------------------------


def parse_pages(pages: DataFrame, value: str = "value") -> DataFrame:
    """Landed page texts to (..., total, items, size): a list, or an object with data or list."""
    keep = [c for c in pages.columns if c != value]
    doc = F.try_parse_json(value)
    items = F.coalesce(_array_at(doc, "$"), _array_at(doc, "$.data"), _array_at(doc, "$.list"))
    return pages.select(
        *keep,
        F.try_variant_get(doc, "$.total", "bigint").alias("total"),
        F.coalesce(items, _no_records()).alias("items"),
        F.coalesce(F.size(items), F.lit(0)).alias("size"),
    )


def assemble_pages(pages: DataFrame, rule: str, date: str = "request_date") -> DataFrame:
    """Records of the pages that a stop rule keeps, with their position.

    ``empty``: pages before the first empty one.  ``short``: up to and including
    the first page with fewer than 10 records.  ``total``: pages 1 to
    ceil(total / 30), total being that of page 1.

    The last page to keep is one small aggregate row per date, joined back: the
    pages themselves are not shuffled, whatever number of them a date has.  It needs
    the pages' sizes and totals only, so stored pages are not parsed again for it.
    """
    size = F.col("size")
    if rule == "empty":
        last = F.min(F.when(size == 0, F.col("page"))) - 1
    elif rule == "short":
        cut = F.when(size < fv.SHORT_PAGE_ROWS, F.col("page") - (size == 0).cast("int"))
        last = F.min(cut)
    elif rule == "total":
        first_total = F.max(F.when(F.col("page") == 1, F.col("total")))
        last = F.ceil(F.coalesce(first_total, F.lit(0)) / F.lit(fv.FEED_PAGE_ROWS))
    else:
        raise ValueError("rule is 'empty', 'short' or 'total'")
    cuts = pages.groupBy(date).agg(last.cast("bigint").alias("last_page"))
    kept = pages.join(cuts, pages[date].eqNullSafe(cuts[date]), "inner").drop(cuts[date])
    kept = kept.filter(F.col("last_page").isNull() | (F.col("page") <= F.col("last_page")))
    columns = [c for c in pages.columns if c not in ("items", "total", "size")]
    return kept.select(*columns, F.posexplode("items").alias("pos", "rec"))


# --- manifest, dates --------------------------------------------------------------


def manifest_dates(manifest: DataFrame, mode: str = "all", value: str = "value") -> DataFrame:
    """Dates of a manifest text, as rows: all in order, or the latest one.

    Takes lists and objects, of date texts or of objects with a date.
    """
    doc = F.try_parse_json(value)
    entries = F.coalesce(_array_at(doc, "$"), _array_at(doc, "$.dates"))
    dates = F.transform(
        entries,
        lambda e: F.coalesce(
            F.try_variant_get(e, "$.date", "string"), F.try_variant_get(e, "$", "string")
        ),
    )
    if mode == "latest":
        latest = F.coalesce(F.try_variant_get(doc, "$.latest", "string"), F.array_max(dates))
        return manifest.select(latest.alias("date")).filter(F.col("date").isNotNull())
    if mode != "all":
        raise ValueError("mode is 'all' or 'latest'")
    return manifest.select(F.explode(dates).alias("date")).orderBy("date")


def load_dates(spark: SparkSession, root: str, dates: list[dt.date | str] | None = None) -> DataFrame:
    """Records of ``root/<date>.json`` for the given dates (all if none); missing dates are skipped."""
    reader = spark.read
    if dates is not None:
        names = ",".join(sorted({str(d) for d in dates}))
        reader = reader.option("pathGlobFilter", "{" + names + "}.json")
    raw = reader.text(root, wholetext=True)
    docs = raw.select(
        F.to_date(F.regexp_extract("_metadata.file_name", _FILE_DATE, 1)).alias("file_date"), "value"
    )
    return explode_landed(docs)


def load_daily_docs(
    spark: SparkSession, root: str, dates: list[dt.date | str] | None = None
) -> DataFrame:
    """(date, rec): records of documents partitioned by date (one record per line); only those dates are read."""
    docs = spark.read.text(root)
    if dates is not None:
        docs = docs.filter(F.col("date").isin([str(d) for d in dates]))
    rows = docs.select("date", F.try_parse_json("value").alias("rec"))
    return rows.filter(_is_object(F.col("rec")))


def manifest_paths(
    spark: SparkSession, root: str, manifest: str, mode: str = "all", dates: list[dt.date | str] | None = None
) -> tuple[list[str], list[str]]:
    """Folders below ``root`` of the dates that a manifest names, and the named dates that have none.

    ``dates`` narrows what is asked for; a date that the manifest does not name is not read.  A manifest has an entry per calendar date.
    """
    named = {r.date for r in manifest_dates(spark.read.text(manifest, wholetext=True), mode).collect()}
    if dates is not None:
        named &= {str(d) for d in dates}
    there = set(list_names(spark, root))
    found = sorted(d for d in named if f"date={d}" in there)
    return [f"{root}/date={d}" for d in found], sorted(named - set(found))


def load_manifest(
    spark: SparkSession, root: str, manifest: str, mode: str = "all", dates: list[dt.date | str] | None = None
) -> DataFrame:
    """(date, rec): records of the dates that a manifest names, all or the latest; only their folders are listed and read."""
    paths, _ = manifest_paths(spark, root, manifest, mode, dates)
    if not paths:
        return spark.createDataFrame([], "date string, rec variant")
    docs = spark.read.schema("value string, date string").option("basePath", root).text(paths)
    rows = docs.select("date", F.try_parse_json("value").alias("rec"))
    return rows.filter(_is_object(F.col("rec")))


# --- dashboard payload ------------------------------------------------------------


def payload_rows(docs: DataFrame, value: str = "value") -> DataFrame:
    """Positional rows (16 or 20 wide) of payload documents as named columns."""
    doc = F.try_parse_json(value)
    rows = docs.select(F.posexplode(_array_at(doc, "$.rows")).alias("pos", "row"))
    return _named(rows)


def payload_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The same for a payload written as one positional row per line."""
    return _named(lines.select(F.try_parse_json(value).alias("row")))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[c for c in rows.columns if c != "row"],
        *[
            F.try_variant_get("row", f"$[{i}]", PAYLOAD_TYPES[name].simpleString()).alias(name)
            for i, name in enumerate(PAYLOAD_COLUMNS)
        ],
    )


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    return payload_rows(spark.read.text(path, wholetext=True))
