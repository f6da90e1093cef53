"""Ids, citations, titles, families and categories of fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapidar.functions.text import slug

DEFAULT = ["legislacao"]
# Categories by family, in order. Families that aren't here have the default.
CATEGORIES = {
    "11": ["processo-normativo"],
    "21": ["certificacao", "projeto", "aeronavegabilidade"],
    "23": ["aeronavegabilidade", "aeronaves-pequenas"],
    "25": ["aeronavegabilidade", "transporte"],
    "26": ["aeronavegabilidade", "envelhecimento"],
    "27": ["aeronavegabilidade", "rotorcraft"],
    "29": ["aeronavegabilidade", "rotorcraft"],
    "31": ["aeronavegabilidade", "baloes"],
    "33": ["motores", "aeronavegabilidade"],
    "34": ["emissoes", "meio-ambiente"],
    "35": ["helices", "aeronavegabilidade"],
    "36": ["ruido", "meio-ambiente"],
    "38": ["ice-protection", "aeronavegabilidade"],
    "39": ["diretrizes-de-aeronavegabilidade"],
    "43": ["manutencao", "aeronavegabilidade"],
    "45": ["identificacao", "aeronavegabilidade"],
    "60": ["simuladores", "treinamento"],
    "61": ["licencas", "pilotos", "pessoal"],
    "63": ["licencas", "tripulacao", "pessoal"],
    "65": ["licencas", "mecanicos", "pessoal"],
    "67": ["saude", "certificado-medico", "pessoal"],
    "90": ["regras-de-voo", "operacoes"],
    "91": ["operacoes-gerais", "regras-de-voo"],
    "103": ["ultraleves", "operacoes"],
    "105": ["paraquedismo", "operacoes"],
    "107": ["seguranca", "aeroporto"],
    "108": ["seguranca", "operador"],
    "110": ["carga", "operacoes"],
    "117": ["fadiga", "jornada", "operacoes"],
    "119": ["certificacao-de-operador", "operacoes"],
    "120": ["antidrogas", "saude"],
    "121": ["transporte-aereo", "operacoes"],
    "129": ["operador-estrangeiro", "operacoes"],
    "133": ["carga-externa", "helicoptero"],
    "135": ["taxi-aereo", "operacoes"],
    "136": ["turismo", "operacoes"],
    "137": ["aeroagricola", "operacoes"],
    "139": ["aerodromos", "infraestrutura"],
    "141": ["escolas", "treinamento"],
    "145": ["organizacao-de-manutencao", "manutencao"],
    "153": ["aerodromos", "operacao-aeroportuaria"],
    "154": ["seguranca-aeroportuaria"],
    "155": ["seguranca-aeroportuaria"],
    "164": ["servicos-aereos"],
    "175": ["artigos-perigosos", "carga"],
    "183": ["delegacao", "credenciamento"],
}


def fragment_id(kind: Column, document: Column, section_id: Column, subsection_id: Column) -> Column:
    """kind-document-section-subsection, the last two as slugs."""
    return F.concat_ws("-", kind, document, slug(section_id), slug(subsection_id))


def cite(section_id: Column, subsection_id: Column) -> Column:
    """The section, with the subsection in brackets unless it is the body; a roman suffix is in capitals."""
    letter, roman = F.split_part(subsection_id, F.lit("-"), F.lit(1)), F.split_part(subsection_id, F.lit("-"), F.lit(2))
    inserted = F.concat(section_id, F.lit("("), letter, F.lit("-"), F.upper(roman), F.lit(")"))
    return F.when(subsection_id == "body", section_id).when(roman != "", inserted).otherwise(F.concat(section_id, F.lit("("), subsection_id, F.lit(")")))


def title(section_id: Column, section_title: Column, subsection_id: Column) -> Column:
    """The section's title for a body, the citation for the rest."""
    return F.when(subsection_id == "body", section_title).otherwise(cite(section_id, subsection_id))


def family(title_: Column) -> Column:
    """The first one to three digits, without leading zeros; null where there are none."""
    return F.regexp_extract(title_, r"\d{1,3}", 0).try_cast("int").cast("string")


def categories(family_: Column) -> Column:
    """The family's categories in order, or the default."""
    known = F.create_map(*(x for k, v in CATEGORIES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.coalesce(F.try_element_at(known, family_), F.array(*map(F.lit, DEFAULT)))


def looks_like_date(section_id: Column) -> Column:
    """A date that a splitter took for a section."""
    return section_id.rlike(r"^\d{2}\.\d{2}\.\d{2,4}$")
