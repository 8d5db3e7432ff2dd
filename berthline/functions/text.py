"""Text columns: labels, defaults, truncation, lists held as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from berthline import fixed_values as fv


_WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def runs(text: Column | str, n: int) -> Column:
    """The n-letter pieces of a name or line, in order."""
    c = _col(text)
    starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(c, i, F.lit(n)))


def join_names(names: Column | str, sep: str = ", ") -> Column:
    """Join the ``name`` of each struct in an array; '' for no array."""
    return F.coalesce(F.concat_ws(sep, F.transform(_col(names), lambda n: n["name"])), F.lit(""))


def join_variant_names(value: Column | str, sep: str = ",") -> Column:
    """Join names of a variant that is a list of objects or texts, a text, or another scalar."""
    v = _col(value)
    kind = F.schema_of_variant(v)

    def name_of(item: Column) -> Column:
        item_kind = F.schema_of_variant(item)
        return F.when(
            item_kind.startswith("OBJECT"), F.try_variant_get(item, "$.name", "string")
        ).when(item_kind == "STRING", F.try_variant_get(item, "$", "string"))

    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), name_of)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind.startswith("ARRAY"), F.concat_ws(sep, F.filter(items, lambda n: n != "")))
        .when(kind == "STRING", text)
        .when(text.isin("0", "false"), F.lit(""))
        .otherwise(F.coalesce(text, F.lit("")))
    )


def price_label(price: Column | str) -> Column:
    """'12,000' or '12,000.5' plus the unit, or the on-request label for 0 or no price."""
    p = _col(price).cast("decimal(38,6)")
    digits = F.regexp_replace(F.format_number(p, 6), r"\.?0+$", "")
    return F.when(
        F.coalesce(p, F.lit(0)) != 0, F.concat(digits, F.lit(fv.PRICE_UNIT))
    ).otherwise(F.lit(fv.PRICE_ON_REQUEST))


def text_price(price: Column | str) -> Column:
    p = _col(price)
    return F.when(F.coalesce(p, F.lit(0)) != 0, p.cast("string")).otherwise(F.lit(""))


def truncate(text: Column | str, n: int) -> Column:
    return F.substring(_col(text), 1, n)


def clock(text: Column | str) -> Column:
    """HH:MM of a time text; '' for none."""
    return F.substring(F.coalesce(_col(text), F.lit("")), 1, 5)


def strip(text: Column | str) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(_col(text), F.lit(_WHITE_SPACE))


def or_default(value: Column | str, default) -> Column:
    """The value unless it is null, '' or 0, else the default."""
    empty = F.lit("") if isinstance(default, str) else F.lit(0)
    return F.coalesce(F.nullif(_col(value), empty), F.lit(default))


def month_label(year_month: Column | str) -> Column:
    ym = _col(year_month)
    return F.when(
        F.length(ym) == 7, F.concat(F.substring(ym, 6, 2), F.lit(fv.MONTH_SUFFIX))
    ).otherwise(ym)


def synthetic_schedule_no(directory_id: Column | str, sdate: Column | str) -> Column:
    return F.concat_ws("_", F.lit("tf"), _col(directory_id), _col(sdate))


def split_species(text: Column | str) -> Column:
    """Array of trimmed, non-empty entries of a comma list."""
    return F.filter(F.transform(F.split(_col(text), ","), lambda t: F.trim(t)), lambda t: t != "")


def display_status_code(code: Column | str) -> Column:
    return or_default(code, fv.STATUS_OPEN)


def display_status_name(name: Column | str) -> Column:
    return or_default(name, fv.STATUS_OPEN_NAME)


def canonical_status(code: Column | str) -> Column:
    """One sold-out code for both marketplaces."""
    c = _col(code)
    return F.when(c == fv.STATUS_FULL, F.lit(fv.STATUS_SOLD_OUT)).otherwise(c)


def page_title(html: Column | str) -> Column:
    return strip(F.regexp_extract(_col(html), "(?dU)" + fv.TITLE_PATTERN, 1))


def page_area(html: Column | str) -> Column:
    area = F.regexp_extract(_col(html), "(?dU)" + fv.AREA_PATTERN, 1)
    return strip(F.regexp_replace(area, fv.AREA_SUFFIX + "+$", ""))


def page_store_id(html: Column | str, directory_id: Column | str) -> Column:
    """Store id by the first of three patterns that hits; two of them contain the page's own id."""
    h, own = _col(html), _col(directory_id)

    def hit(pattern: Column) -> Column:
        return F.nullif(F.call_function("regexp_extract", h, pattern, F.lit(1)), F.lit(""))

    flags = "(?dU)"
    return F.coalesce(
        hit(F.concat(F.lit(flags + fv.STORE_ID_PATTERN_LINK), own)),
        hit(F.concat(F.lit(flags + fv.STORE_ID_PATTERN_CALL), own)),
        hit(F.lit(flags + fv.STORE_ID_PATTERN_AJAX)),
    )


def expand_synonyms(term: str, synonyms: list[tuple[str, list[str]]] | None = None) -> list[str]:
    """Expansion of one query term: exact entry, else first list with a containment, else itself."""
    table = fv.SPECIES_SYNONYMS if synonyms is None else synonyms
    term = term.strip()
    if not term:
        return [term]
    exact = dict(table)
    if term in exact:
        return exact[term]
    near = (words for _, words in table if any(term in w or w in term for w in words))
    return next(near, [term])
