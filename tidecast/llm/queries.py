"""Queries of the operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chaining, collocations, decontaminate, itq, licenses, mixing, preference, secrets, simhash, toxicity, turn_repair, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_warc": warc.op2_warc,
    "op3_chaining": chaining.op3_chaining,
    "op4_mixing": mixing.op4_mixing,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_simhash": simhash.op6_simhash,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_preference": preference.op8_preference,
    "op9_itq": itq.op9_itq,
    "op10_secrets": secrets.op10_secrets,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_collocations": collocations.op12_collocations,
    "op13_licenses": licenses.op13_licenses,
}
SQL: dict[str, str] = {
    "op1_url_filter": url_filter.SQL,
    "op2_warc": warc.SQL,
    "op4_mixing": mixing.SQL,
    "op8_preference": preference.SQL,
    "op10_secrets": secrets.SQL,
    "op11_turn_repair": turn_repair.SQL,
    "op12_collocations": collocations.SQL,
    "op13_licenses": licenses.SQL,
}
