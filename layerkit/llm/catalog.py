"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from ..sources.tables import table
from . import bpe, exactdedup, fptree, licenses, lines, mixing, neardup, pii, quality, spelling, substring, toxicity, wavelet


def op1_debruijn_substring_dedup(spark, sf_dir):
    return substring.digest(substring.remove_repeats(table(spark, sf_dir, "documents")))


def op2_compression_quality(spark, sf_dir):
    return quality.measure_quality(table(spark, sf_dir, "documents"))


def op3_backtracking_bpe(spark, sf_dir):
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"))


def op4_information_pii(spark, sf_dir):
    return pii.report(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op5_curriculum_mix(spark, sf_dir):
    return mixing.taken(mixing.plan_mix(table(spark, sf_dir, "documents")))


def op6_wavelet_tokens(spark, sf_dir):
    return wavelet.round_trip(table(spark, sf_dir, "documents"))


def op7_mil_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bayesian_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op9_license_dice(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_heavy_hitter_dedup(spark, sf_dir):
    return exactdedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_fptree_search(spark, sf_dir):
    return fptree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_line_dedup(spark, sf_dir):
    return lines.digest(lines.cleaned(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_debruijn_substring_dedup, op2_compression_quality, op3_backtracking_bpe, op4_information_pii, op5_curriculum_mix,
    op6_wavelet_tokens, op7_mil_toxicity, op8_bayesian_near_dedup, op9_license_dice, op10_heavy_hitter_dedup,
    op11_spelling_variants, op12_fptree_search, op13_line_dedup)}
ORACLE = {"op1_debruijn_substring_dedup": substring.ORACLE, "op5_curriculum_mix": mixing.ORACLE, "op8_bayesian_near_dedup": neardup.ORACLE, "op9_license_dice": licenses.ORACLE,
          "op10_heavy_hitter_dedup": exactdedup.ORACLE, "op11_spelling_variants": spelling.ORACLE, "op12_fptree_search": fptree.ORACLE, "op13_line_dedup": lines.ORACLE}
