"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from siltstone.llm.ann import op4_ann
from siltstone.llm.hpylm import op8_hpylm
from siltstone.llm.licenses import ORACLE as OP1_SQL
from siltstone.llm.licenses import op1_licenses
from siltstone.llm.mixing import op3_mixing
from siltstone.llm.oph import op2_oph
from siltstone.llm.packing import op6_packing
from siltstone.llm.quality import op5_quality
from siltstone.llm.simhash import op9_simhash
from siltstone.llm.tokenfile import op7_tokenfile
from siltstone.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_oph": op2_oph,
    "op3_mixing": op3_mixing,
    "op4_ann": op4_ann,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_tokenfile": op7_tokenfile,
    "op8_hpylm": op8_hpylm,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {"op1_licenses": OP1_SQL}
