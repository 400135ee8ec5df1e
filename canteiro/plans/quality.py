"""Quality report: counts, coverage by source, distributions and audits that must be empty."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.operators.profile import (
    Section,
    coverage,
    distribution,
    exact_mean,
    largest_first,
    null_checks,
    null_or_empty,
    report_sections,
    row_counts,
)

STRUCTURED = ("obras", "contratos", "fornecedores", "aditivos")


def counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    named = {f"{n} (estruturada)" if n in STRUCTURED else n: df for n, df in tables.items()}
    return row_counts(named).orderBy("tabela")


def raw_contracts_checks() -> dict[str, Column]:
    return {
        "sem_situacao": null_or_empty("situacao"),
        **null_checks(
            sem_valor="valor_inicial", sem_data_assinatura="data_assinatura", sem_data_fim="data_fim_vigencia",
            sem_cnpj="cnpj_fornecedor",
        ),
        "vigentes": F.col("situacao") == "Vigente",
        "expirados": F.col("situacao") == "Expirado",
        "indefinidos": F.col("situacao") == "Indefinido",
    }


def raw_contracts(df: DataFrame) -> DataFrame:
    return largest_first(coverage(df, ["fonte"], raw_contracts_checks()), "total", "fonte")


def raw_tenders_checks() -> dict[str, Column]:
    return {
        **null_checks(sem_situacao="situacao", sem_valor="valor_estimado", sem_vencedor="cnpj_vencedor"),
        "sem_data": F.col("data_publicacao").isNull() & F.col("data_abertura").isNull(),
    }


def raw_tenders(df: DataFrame) -> DataFrame:
    return largest_first(coverage(df, ["fonte"], raw_tenders_checks()), "total", "fonte")


# raw table -> named NULL checks
RAW_WORKS_CHECKS = {
    "raw_obras_saude": dict(
        sem_situacao="situacao", sem_percentual="percentual_executado", sem_valor_proposta="valor_proposta",
        sem_valor_contrato="valor_total_contrato", sem_cnes="cnes", sem_dt_inicio_obra="dt_inicio_obra",
        sem_lat="latitude",
    ),
    "raw_obras_georef": dict(
        sem_situacao="situacao", sem_percentual="percentual", sem_valor="valor",
        sem_previsao_termino="previsao_termino", sem_bairro="bairro", sem_lat="latitude",
    ),
    "raw_obras_atual": dict(
        sem_situacao="situacao", sem_percentual="percentual_executado", sem_valor="valor_contrato",
        sem_data_inicio="data_inicio", sem_data_fim="data_prevista_fim", sem_secretaria="secretaria",
        sem_lat="latitude",
    ),
    "raw_obras_legado": dict(
        sem_situacao="situacao", sem_percentual="percentual_executado", sem_valor="valor_contrato",
        sem_data_inicio="data_inicio", sem_secretaria="secretaria", sem_lat="latitude",
    ),
    "raw_obras_paralisadas": dict(
        sem_situacao="situacao", sem_valor="valor_contrato", sem_motivo="motivo_paralisacao",
        sem_data_inicio="data_inicio",
    ),
}


def raw_works(table: str, df: DataFrame) -> DataFrame:
    return coverage(df, ["fonte"], null_checks(**RAW_WORKS_CHECKS[table]))


# named NULL checks of the consolidated works
WORKS_CHECKS = dict(
    sem_situacao="situacao", sem_percentual="percentual_executado", sem_valor="valor_contrato",
    sem_lat="latitude", sem_data_inicio="data_inicio", sem_data_fim="data_prevista_fim",
)


def works_coverage(works: DataFrame) -> DataFrame:
    report = coverage(
        works, ["fonte_origem"], null_checks(**WORKS_CHECKS), {"media_percentual": "percentual_executado"}
    )
    return largest_first(report, "total", "fonte_origem")


def works_status(works: DataFrame) -> DataFrame:
    report = distribution(works, "situacao", {"media_percentual": "percentual_executado"})
    return largest_first(report, "qtd", "situacao")


def contract_status_by_source(contracts: DataFrame) -> DataFrame:
    groups = contracts.groupBy("fonte_origem", "situacao").agg(F.count("*").alias("qtd"))
    return groups.orderBy("fonte_origem", F.col("qtd").desc(), "situacao")


def works_without_percent(works: DataFrame) -> DataFrame:
    """Must be empty."""
    return works.where(F.col("percentual_executado").isNull()).select(
        "fonte_origem", "id_origem", "nome", "situacao", "percentual_executado"
    )


def contracts_without_status(contracts: DataFrame) -> DataFrame:
    """Must be empty."""
    return contracts.where(null_or_empty("situacao")).select(
        "fonte_origem", "numero", F.substring("objeto", 1, 60).alias("objeto"), "situacao", "data_inicio", "data_fim"
    )


def _counted(checks: Mapping[str, Column]) -> dict[str, Column]:
    return {"total": F.count("*"), **{name: F.count_if(check) for name, check in checks.items()}}


def table_sections(name: str) -> list[Section]:
    """Sections of the report for one table: its count, and what the table is known for."""
    label = f"{name} (estruturada)" if name in STRUCTURED else name
    sections = [Section("contagens", (), {label: F.count("*")})]
    mean = {"media_percentual": exact_mean("percentual_executado", 1)}
    if name == "raw_contratos":
        sections.append(Section(f"cobertura_{name}", ("fonte",), _counted(raw_contracts_checks())))
    elif name == "raw_licitacoes":
        sections.append(Section(f"cobertura_{name}", ("fonte",), _counted(raw_tenders_checks())))
    elif name in RAW_WORKS_CHECKS:
        sections.append(Section(f"cobertura_{name}", ("fonte",), _counted(null_checks(**RAW_WORKS_CHECKS[name]))))
    elif name == "obras":
        sections += [
            Section("cobertura_obras", ("fonte_origem",), {**_counted(null_checks(**WORKS_CHECKS)), **mean}),
            Section("situacao_obras", ("situacao",), {"qtd": F.count("*"), **mean}, share="pct"),
            Section("obras_sem_percentual", (), {"linhas": F.count_if(F.col("percentual_executado").isNull())}),
        ]
    elif name == "contratos":
        sections += [
            Section("situacao_contratos", ("fonte_origem", "situacao"), {"qtd": F.count("*")}),
            Section("contratos_sem_situacao", (), {"linhas": F.count_if(null_or_empty("situacao"))}),
        ]
    return sections


def report_lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All sections whose tables are given as one frame: secao, grupo, medida, valor.

    Each table is read once, whatever the number of its sections. Of the audits that must be empty, the lines give the
    number of rows; ``report`` gives the rows.
    """
    parts = [report_sections(df, table_sections(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def report(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All sections whose tables are given."""
    sections = {"contagens": counts(tables)}
    single = {
        "raw_contratos": raw_contracts,
        "raw_licitacoes": raw_tenders,
        **{name: (lambda df, name=name: raw_works(name, df)) for name in RAW_WORKS_CHECKS},
    }
    for name, section in single.items():
        if name in tables:
            sections[f"cobertura_{name}"] = section(tables[name])
    if "obras" in tables:
        sections["cobertura_obras"] = works_coverage(tables["obras"])
        sections["situacao_obras"] = works_status(tables["obras"])
        sections["obras_sem_percentual"] = works_without_percent(tables["obras"])
    if "contratos" in tables:
        sections["situacao_contratos"] = contract_status_by_source(tables["contratos"])
        sections["contratos_sem_situacao"] = contracts_without_status(tables["contratos"])
    return sections
