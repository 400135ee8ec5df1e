"""The structured tables after a change of the raw contracts, computing only what the change reaches.

Two versions of the raw contracts differ in some rows. A supplier is reached by a row that names it, before or after; a
work by its own row; a contract by every row of its number and source, since the last of them is kept; an amendment by its
contract. Rows that are not reached are taken over, the others are computed again from the new version. The result equals
a full run with the same ``as_of``: what depends on the clock is not looked at again, so a run of a later day computes
works as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.ids import surrogate_key
from canteiro.functions.text import blank_to_null, mentions_works, strip
from canteiro.operators.fields import field, first_filled
from canteiro.plans.contracts import amendments, contracts
from canteiro.plans.suppliers import suppliers
from canteiro.plans.works import work_keys, works

RAW_KEY = ("id_contrato", "fonte")
# columns that the works' secretariat comes from: the first that has a value in any work
PLACES = ("secretaria", "orgao", "unidade_gestora")


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row was added, removed or changed; both versions are unique by key and have no NULL in it.

    Only the keys and a hash of each row are shuffled. A column that one version lacks counts as NULL there.
    """
    names = sorted({*old.columns, *new.columns} - set(keys))
    # cells of one exact type are hashed as they are, others by their text
    kinds = dict(old.dtypes).items() & dict(new.dtypes).items()
    exact = {column for column, kind in kinds if kind in ("timestamp", "date", "boolean", "int", "bigint", "string")}

    def hashed(df: DataFrame, name: str) -> DataFrame:
        cells = [F.col(f"`{column}`") if column in exact else field(df, column).cast("string") for column in names]
        return df.select(*keys, F.xxhash64(*[part for cell in cells for part in (cell.isNull(), cell)]).alias(name))

    both = hashed(old, "__old").join(hashed(new, "__new"), list(keys), "full_outer")
    return both.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(*keys)


def _choice(raw: DataFrame) -> Column:
    """Place of the column that the secretariat of all works comes from."""
    chosen = raw.where(mentions_works(field(raw, "objeto")))
    place = F.lit(len(PLACES) - 1)
    for number, name in reversed(list(enumerate(PLACES[:-1]))):
        if name in raw.columns:
            some = chosen.where(F.col(name).isNotNull()).select(F.lit(1).alias("one")).limit(1).agg(F.count("one")).scalar() > 0
            place = F.when(some, number).otherwise(place)
    return place


def _replaced(before: DataFrame, reached: DataFrame, on: Sequence[str], again: DataFrame) -> DataFrame:
    """Rows that are not reached, and the reached ones as they are now."""
    return before.join(reached, list(on), "left_anti").unionByName(again.select(*before.columns))


def refreshed(
    before: Mapping[str, DataFrame],
    old: DataFrame,
    new: DataFrame,
    as_of: Column,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """The four tables for the new raw contracts, from those of the old ones.

    ``stage`` writes a frame and reads it back; what is used more than once goes through it. Works of other sources in
    ``before`` stay as they are.
    """
    keys = stage(changed_keys(old, new, RAW_KEY))

    def reaching(df: DataFrame) -> DataFrame:
        """What a changed row says of its supplier and its number."""
        cells = [name for name in ("cnpj_fornecedor", "num_licitacao") if name in df.columns]
        return df.select(*RAW_KEY, *cells).join(keys, list(RAW_KEY), "left_semi")

    touched = stage(reaching(old).unionByName(reaching(new), allowMissingColumns=True))
    result = {}

    named_there = touched.select(strip(field(touched, "cnpj_fornecedor")).alias("cnpj"))
    numbers = stage(named_there.where(blank_to_null("cnpj").isNotNull()).distinct())
    named = new.withColumn("cnpj", strip(field(new, "cnpj_fornecedor"))).join(numbers, "cnpj", "left_semi").drop("cnpj")
    result["fornecedores"] = _replaced(before["fornecedores"], numbers, ["cnpj"], suppliers(named))

    # a choice that is made for all works at once reaches all of them when it turns out otherwise
    choice = _choice(new)
    moved = new.where(choice != _choice(old)).select(*RAW_KEY)
    own = stage(keys.unionByName(moved).distinct())
    rows = new.join(own, list(RAW_KEY), "left_semi")
    place = F.lit(None).cast("string")
    for number, name in enumerate(PLACES):
        place = F.when(choice == number, field(new, name).cast("string")).otherwise(place)
    settled = rows.withColumn("secretaria", place).drop(*PLACES[1:])
    known = own.select(F.col("id_contrato").cast("string").alias("id_origem"), F.col("fonte").alias("fonte_origem"))
    result["obras"] = _replaced(
        before["obras"], known, ["fonte_origem", "id_origem"], works({"raw_contratos": settled}, as_of)[0]
    )

    def numbered(df: DataFrame) -> DataFrame:
        number = first_filled(field(df, "num_licitacao"), F.col("id_contrato").cast("string"))
        return df.withColumns({"numero": number, "fonte_origem": F.col("fonte")})

    pair = ["numero", "fonte_origem"]
    reached = stage(numbered(touched).select(*pair).distinct())
    again = stage(numbered(new).join(reached, pair, "left_semi").drop(*pair))
    linked = stage(contracts(again, work_keys({"raw_contratos": again}), suppliers(again), as_of)[0])
    result["contratos"] = _replaced(before["contratos"], reached, pair, linked)
    ids = reached.select(surrogate_key(*pair).alias("id_contrato"))
    result["aditivos"] = _replaced(before["aditivos"], ids, ["id_contrato"], amendments(again, linked)[0])
    return result
