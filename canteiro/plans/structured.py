"""The structured run: suppliers, works, contracts, amendments, in key order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from canteiro.operators.fields import raw_payload
from canteiro.operators.merge import VersionedTable, read_sources, staging_table, stamped
from canteiro.plans.contracts import amendments, contracts
from canteiro.plans.suppliers import suppliers
from canteiro.plans.works import work_keys, works
from canteiro.routes import RAW_TABLES

@dataclass(frozen=True)
class Outcome:
    """What a step did: version and rows written, rows rejected, or the error that stopped it."""

    version: int | None
    written: int
    rejected: int
    error: str | None = None


REASONS = {"obras": "sem identificador de origem", "contratos": "sem obra", "aditivos": "sem contrato"}

KEYS = {
    "fornecedores": ["cnpj"],
    "obras": ["fonte_origem", "id_origem"],
    "contratos": ["numero", "fonte_origem"],
    "aditivos": ["id_contrato"],
}


def structured_tables(
    raw: Mapping[str, DataFrame],
    as_of: Column,
    gazetteer: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """The four tables as one lazy plan: keys are derived from the natural ones, so nothing has
    to be written and read back to learn them.

    ``stage`` may write a table and read it back; those that a later table reads go through it.
    """
    result = {"fornecedores": stage(suppliers(raw["raw_contratos"]))}
    result["obras"], _ = works(raw, as_of, gazetteer)
    # a contract's work comes from the contract's own source: other sources, and what enriches a
    # work, stay out of these two branches
    keys = work_keys({"raw_contratos": raw["raw_contratos"]})
    result["contratos"] = stage(contracts(raw["raw_contratos"], keys, result["fornecedores"], as_of)[0])
    result["aditivos"], _ = amendments(raw["raw_contratos"], result["contratos"])
    return result


def run(
    spark: SparkSession,
    raw_root: str,
    root: str,
    as_of: Column,
    gazetteer: DataFrame | None = None,
    staging: str | None = None,
) -> dict[str, Outcome]:
    """Upsert the four tables. Each one is written before the next reads it, which cuts the
    lineage at a durable table; a failed step does not stop the later ones. Rows without an id or
    a partner go to the table ``rejeitados`` with their reason and their record."""
    raw = {name: read_sources(spark, f"{raw_root}/{name}") for name in RAW_TABLES}
    raw = {name: df for name, df in raw.items() if df is not None}
    tables = {name: VersionedTable(spark, f"{root}/{name}") for name in KEYS}

    def build_contracts() -> tuple[DataFrame, DataFrame]:
        return contracts(raw["raw_contratos"], tables["obras"].read(), tables["fornecedores"].read(), as_of)

    steps: dict[str, Callable[[], tuple[DataFrame, DataFrame | None]]] = {
        "fornecedores": lambda: (suppliers(raw["raw_contratos"]), None),
        "obras": lambda: works(raw, as_of, gazetteer),
        "contratos": build_contracts,
        "aditivos": lambda: amendments(raw["raw_contratos"], tables["contratos"].read()),
    }
    outcome: dict[str, Outcome] = {}
    for name, build in steps.items():
        staged = staging_table(spark, name, staging or f"{root}/_staging")
        try:
            rows, rejected = build()
            # staged once: the merge reads its batch more than once
            staged.write(stamped(rows, as_of))
            batch = staged.read()
            version = tables[name].upsert(batch, KEYS[name])
            n_rejected = 0 if rejected is None else _kept_rejects(rejected, name, root, as_of)
            outcome[name] = Outcome(version, batch.count(), n_rejected)
        except Exception as error:  # steps are independent where their inputs exist
            outcome[name] = Outcome(None, 0, 0, str(error))
        finally:
            staged.discard()
    return outcome


def _kept_rejects(rejected: DataFrame, name: str, root: str, as_of: Column) -> int:
    """Append rows without an id or a partner to the reject table; returns their number."""
    seen = Observation()
    listed = rejected.observe(seen, F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("tabela"),
        F.lit(REASONS[name]).alias("motivo"),
        raw_payload(rejected).alias("registro"),
        as_of.cast("timestamp").alias("executado_em"),
    )
    listed.write.mode("append").parquet(f"{root}/rejeitados")
    return seen.get["n"]
