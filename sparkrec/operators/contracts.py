"""Schema contracts: column sets, types and row rules, all violations at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

Rule = Callable[[Column], Column]
EVENT_TYPES = ("view", "cart", "purchase", "rating")  # fixed values


def at_least(low: float) -> tuple[str, Rule]:
    return f"at_least_{low:g}", lambda c: c >= low


def in_range(low: float, high: float) -> tuple[str, Rule]:
    return f"in_range_{low:g}_{high:g}", lambda c: c.between(low, high)


def one_of(*values: str) -> tuple[str, Rule]:
    return "one_of", lambda c: c.isin(*values)


def max_length(n: int) -> tuple[str, Rule]:
    return f"max_length_{n}", lambda c: F.size(c) <= n


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    nullable: bool = False
    rules: tuple[tuple[str, Rule], ...] = ()
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: str
    row_rules: tuple[tuple[str, Column], ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.nullable) for f in self.fields])

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


class ContractError(ValueError):
    """Carries every problem found, not just the first."""

    def __init__(self, contract: str, problems: Sequence[str]):
        super().__init__(f"{contract}: " + "; ".join(problems))
        self.problems = list(problems)


def column_problems(df: DataFrame, contract: Contract) -> list[str]:
    """Missing and surplus columns; contracts are strict."""
    have, want = set(df.columns), set(contract.names)
    missing = [f"{c}: column missing" for c in contract.names if c not in have]
    surplus = [f"{c}: column not in contract" for c in df.columns if c not in want]
    return missing + surplus


def fill_missing_optional(df: DataFrame, contract: Contract) -> DataFrame:
    """Nullable columns that are absent come back as NULL; required ones stay absent."""
    absent = [f for f in contract.fields if f.nullable and f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.type).alias(f.name) for f in absent])


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns only, in contract order and type."""
    return df.select([F.col(f.name).cast(f.type).alias(f.name) for f in contract.fields])


def stamp_lineage(df: DataFrame, run_id: Column | str, ingested_at) -> DataFrame:
    """One extraction id and one ingest time for the whole commit."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return df.withColumns({"_extraction_run_id": run, "_ingested_at": F.lit(ingested_at)})


def _row_checks(contract: Contract) -> list[tuple[str, str, Column]]:
    checks = []
    for f in contract.fields:
        raw, value = F.col(f.name), F.col(f"__typed_{f.name}")
        checks.append((f.name, "type", raw.isNotNull() & value.isNull()))
        if not f.nullable:
            checks.append((f.name, "not_null", raw.isNull()))
        for label, rule in f.rules:
            checks.append((f.name, label, value.isNotNull() & ~rule(value)))
    checks.extend(("*", label, ~F.coalesce(ok, F.lit(False))) for label, ok in contract.row_rules)
    return checks


def check_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns, coerced, plus `failures`: array of (column_name, check_name)."""
    typed = df.select(
        *contract.names,
        *[F.col(f.name).try_cast(f.type).alias(f"__typed_{f.name}") for f in contract.fields],
    )
    hits = [
        F.when(bad, F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("check_name")))
        for c, k, bad in _row_checks(contract)
    ]
    return typed.withColumn("failures", F.array_compact(F.array(*hits))).select(
        *[F.col(f"__typed_{f.name}").alias(f.name) for f in contract.fields], "failures"
    )


def split_valid(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows without failures, rejected rows with their failures); columns must match."""
    problems = column_problems(df, contract)
    if problems:
        raise ContractError(contract.name, problems)
    checked = check_rows(df, contract)
    good = checked.filter(F.size("failures") == 0).drop("failures")
    return good, checked.filter(F.size("failures") > 0)


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of a unique column that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Every violation as (column_name, check_name, row_key, n)."""
    problems = column_problems(df, contract)
    if problems:
        raise ContractError(contract.name, problems)
    checked = check_rows(df, contract)
    key = F.col(contract.key).cast("string").alias("row_key")
    rows = checked.filter(F.size("failures") > 0).select(F.explode("failures").alias("f"), key)
    out = rows.select("f.column_name", "f.check_name", "row_key", F.lit(1).cast("long").alias("n"))
    for f in contract.fields:
        if f.unique:
            out = out.unionByName(
                duplicate_keys(checked, f.name).select(
                    F.lit(f.name).alias("column_name"), F.lit("unique").alias("check_name"),
                    F.col(f.name).cast("string").alias("row_key"), "n",
                )
            )
    return out


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Coerced rows, or `ContractError` naming each failing (column, check) with its count.

    Only the counts per rule reach the driver.
    """
    problems = column_problems(df, contract)
    if not problems:
        summary = failures(df, contract).groupBy("column_name", "check_name").agg(F.sum("n").alias("n"))
        problems = [f"{r.column_name}: {r.check_name} ({r.n})" for r in
                    summary.orderBy("column_name", "check_name").collect()]
    if problems:
        raise ContractError(contract.name, problems)
    return conform(df, contract)


def rating_matches_event() -> Column:
    """A rating is present exactly for rating events."""
    return (F.col("event_type") == "rating") == F.col("rating").isNotNull()


def unknown_references(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Rows whose reference does not exist in `known`."""
    return df.join(
        known.select(F.col(known_column).alias(column)), column, "left_anti"
    )


def require_references(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """`df` itself; the job fails at the first row whose reference is unknown."""
    flags = known.select(F.col(known_column).alias(column), F.lit(True).alias("__known")).distinct()
    found = F.coalesce("__known", F.raise_error(f"{column}: value missing from {known_column}").cast("boolean"))
    return df.join(flags, column, "left").filter(found).drop("__known")


_MONEY, _STARS, _TS = T.DecimalType(12, 2), T.DecimalType(2, 1), T.TimestampType()
_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_LINEAGE = (Field("_extraction_run_id", _S), Field("_ingested_at", _TS))


def _products(unique: bool) -> tuple[Field, ...]:
    return (
        Field("product_id", _S, unique=unique),
        Field("title", _S),
        Field("category", _S),
        Field("category_path", _S, nullable=True),
        Field("brand", _S, nullable=True),
        Field("price", _MONEY, nullable=True, rules=(at_least(0),)),
        Field("description", _S, nullable=True),
        Field("image_url", _S, nullable=True),
        Field("is_active", _B),
        Field("created_at", _TS),
        Field("updated_at", _TS),
    )


def _interactions(unique: bool) -> tuple[Field, ...]:
    return (
        Field("interaction_id", _L, unique=unique),
        Field("user_id", _S),
        Field("product_id", _S),
        Field("event_type", _S, rules=(one_of(*EVENT_TYPES),)),
        Field("rating", _STARS, nullable=True, rules=(in_range(1, 5),)),
        Field("event_time", _TS),
        Field("created_at", _TS),
        Field("updated_at", _TS),
    )


BRONZE_PRODUCTS = Contract("bronze.products", _products(False) + _LINEAGE, "product_id")
SILVER_PRODUCTS = Contract("silver.products", _products(True), "product_id")
BRONZE_INTERACTIONS = Contract("bronze.interactions", _interactions(False) + _LINEAGE, "interaction_id")
SILVER_INTERACTIONS = Contract("silver.interactions", _interactions(True), "interaction_id")

ITEM_FEATURES = Contract(
    "gold.item_features",
    (
        Field("product_id", _S, unique=True),
        Field("title", _S),
        Field("category", _S),
        Field("category_path", _S, nullable=True),
        Field("brand", _S, nullable=True),
        Field("price", _MONEY, nullable=True),
        Field("image_url", _S, nullable=True),
        *[Field(c, _L, rules=(at_least(0),)) for c in (
            "num_interactions", "num_views", "num_cart_adds", "num_purchases", "num_ratings")],
        Field("avg_rating", _D, nullable=True, rules=(in_range(1, 5),)),
        Field("distinct_users", _L, rules=(at_least(0),)),
        Field("last_interaction_at", _TS, nullable=True),
        Field("computed_at", _TS),
    ),
    "product_id",
)

USER_FEATURES = Contract(
    "gold.user_features",
    (
        Field("user_id", _S, unique=True),
        Field("item_sequence", T.ArrayType(_S), rules=(max_length(10),)),
        Field("event_time_sequence", T.ArrayType(_TS), rules=(max_length(10),)),
        Field("sequence_length", _I, rules=(in_range(1, 10),)),
        Field("last_event_time", _TS),
        Field("computed_at", _TS),
    ),
    "user_id",
)
