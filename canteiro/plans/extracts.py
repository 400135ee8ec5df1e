"""Extracts as the sources give them, to the records that the raw tables take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from canteiro.operators.records import by_name
from canteiro.plans.ingest import Normaliser
from canteiro.sources import court, federal, georef, health, panels, portal
from canteiro.sources.common import carried


def _court_contracts(df: DataFrame, as_of: Column) -> DataFrame:
    return court.contracts(court.of_municipality(by_name(df, ["Ente"]), "Ente"), as_of)


def _court_amendments(df: DataFrame, as_of: Column) -> DataFrame:
    return court.amendments(court.amended_agreements(court.of_municipality(by_name(df, ["Ente"]), "Ente")), as_of)


def _court_stopped_works(df: DataFrame, as_of: Column) -> DataFrame:
    return court.stopped_works(court.of_municipality(by_name(df, ["Ente"]), "Ente"), as_of)


def _current_panel(df: DataFrame, as_of: Column) -> DataFrame:
    return panels.active_works(panels.current_works(panels.of_municipality(df), as_of), as_of)


def _map_works(df: DataFrame, as_of: Column) -> DataFrame:
    return georef.works(georef.parse_placemarks(df), as_of)


def _federal_agreements(df: DataFrame, as_of: Column) -> DataFrame:
    return federal.agreements(df, as_of, carried(df))


# dataset -> normaliser; datasets that are not listed arrive in normal form
NORMALISERS: dict[str, Normaliser] = {
    "tce_rj_contratos": _court_contracts,
    "tce_rj_aditivos": _court_amendments,
    "tce_rj_obras": _court_stopped_works,
    "tce_contratos": court.purchases,
    "tce_licitacoes": court.tenders,
    "portal_macae_contratos": portal.contracts,
    "portal_macae_licitacoes": portal.tenders,
    "sismob": health.works,
    "egim": _map_works,
    "painel_atual": _current_panel,
    "painel_legado_obras": panels.legacy_works,
    "transparencia_convenios": _federal_agreements,
}

# of these, the ones that look up the fields of records that have no schema in common
BY_RECORD = frozenset({"tce_rj_contratos", "tce_rj_aditivos", "tce_rj_obras", "tce_contratos", "tce_licitacoes"})
