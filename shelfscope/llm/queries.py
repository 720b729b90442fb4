"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import functools

from . import langid, mixing, outliers, packing, pages, phrases, quality, repeats, secrets, simhash, toxicity, tries, vectors
from .common import prepare

_QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_mixing": mixing.op2_mixing,
    "op3_repeats": repeats.op3_repeats,
    "op4_vectors": vectors.op4_vectors,
    "op5_outliers": outliers.op5_outliers,
    "op6_pages": pages.op6_pages,
    "op7_secrets": secrets.op7_secrets,
    "op8_langid": langid.op8_langid,
    "op9_simhash": simhash.op9_simhash,
    "op10_packing": packing.op10_packing,
    "op11_tries": tries.op11_tries,
    "op12_quality": quality.op12_quality,
    "op13_collocations": phrases.op13_collocations,
}

ORACLE: dict[str, str] = {"op11_tries": tries.ORACLE, "op13_collocations": phrases.ORACLE}


def _prepared(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {name: _prepared(fn) for name, fn in _QUERIES.items()}
