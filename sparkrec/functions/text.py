"""Text, category, price and display expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Separators and markers stored in the tables.
PATH_SEPARATOR = " > "
TEXT_SEPARATOR = " | "
DISPLAY_SEPARATOR = " · "
MISSING = "[MISSING]"
UNK = "[UNK]"
PAD = "[PAD]"

# One class for every Unicode white-space character; valid in Java and RE2.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(value: Column | str) -> Column:
    """White-space runs become one blank, ends are stripped."""
    return F.trim(F.regexp_replace(_col(value), f"{SPACE}+", " "))


def strip(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), f"^{SPACE}+|{SPACE}+$", "")


def clean(value: Column | str) -> Column:
    """Collapsed text, NULL when nothing is left."""
    return F.nullif(collapse(value), F.lit(""))


def clean_number(value: Column | str) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(_col(value)), _col(value))


def source_category(main_category: Column | str, categories: Column | str) -> Column:
    """Main category if not blank, else the first listed one, else `unknown`."""
    main = _col(main_category)
    return F.coalesce(
        F.when(strip(main) != "", main), F.get(_col(categories), F.lit(0)), F.lit("unknown")
    )


def category_path(categories: Column | str) -> Column:
    levels = F.filter(F.transform(_col(categories), collapse), lambda x: x != "")
    return F.nullif(F.array_join(levels, PATH_SEPARATOR), F.lit(""))


def split_category_path(path: Column | str) -> Column:
    levels = F.filter(F.transform(F.split(_col(path), PATH_SEPARATOR), strip), lambda x: x != "")
    return F.when(F.size(levels) > 0, levels)


def raw_categories(categories: Column | str, main_category: Column | str, levels: int = 3) -> Column:
    """First cleaned levels; without any, the main category; without that, none."""
    empty = F.array().cast("array<string>")
    cleaned = F.transform(F.coalesce(_col(categories), empty), clean)
    kept = F.slice(F.filter(cleaned, lambda x: x.isNotNull()), 1, levels)
    main = clean(main_category)
    return F.when(F.size(kept) > 0, kept).when(main.isNotNull(), F.array(main)).otherwise(empty)


def positive_price(price: Column | str) -> Column:
    """The price as double, NULL unless finite and above zero."""
    p = _col(price).cast("double")
    return F.when((p > 0) & ~F.isnan(p) & (p < F.lit(float("inf"))), p)


def parse_price(value: Column | str) -> Column:
    """Price text with currency sign and thousands separators to double."""
    bare = strip(F.regexp_replace(_col(value).cast("string"), "[$,]", ""))
    digits = F.regexp_replace(bare, "(?<=[0-9])_(?=[0-9])", "")
    return positive_price(F.when(digits.rlike(NUMBER), digits.try_cast("double")))


def item_text(title: Column | str, categories: Column | str) -> Column:
    """Title and categories, parts that are missing left out."""
    path = F.nullif(F.array_join(_col(categories), PATH_SEPARATOR), F.lit(""))
    return F.concat_ws(TEXT_SEPARATOR, clean(title), path)


def display_description(category: Column | str, price: Column | str) -> Column:
    """`category · $price`, or the category alone; prices through decimal, so rounding is exact."""
    name = F.nullif(_col(category), F.lit(""))
    amount = _col(price).cast("decimal(12,2)").cast("string")
    with_price = F.concat(name, F.lit(DISPLAY_SEPARATOR + "$"), amount)
    return F.when(_col(price).isNotNull(), with_price).otherwise(name)


def split_description(description: Column | str) -> Column:
    """Struct (category, price) cut at the last separator, if a price follows it."""
    text = F.coalesce(_col(description), F.lit(""))
    tail = F.substring_index(text, DISPLAY_SEPARATOR, -1)
    priced = (F.instr(text, DISPLAY_SEPARATOR) > 0) & tail.startswith("$")
    head = F.substring(text, F.lit(1), F.length(text) - F.length(tail) - len(DISPLAY_SEPARATOR))
    return F.struct(
        F.when(priced, head).otherwise(text).alias("category"),
        F.when(priced, tail).otherwise(F.lit("")).alias("price"),
    )


def from_epoch_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def category_tokens(categories: Column | str) -> Column:
    """Blanks inside one level become underscores, so a level is one token."""
    return F.transform(_col(categories), lambda x: F.replace(x, F.lit(" "), F.lit("_")))
