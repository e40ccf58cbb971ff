"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from lumenframe.llm.decontaminate import op6_templates
from lumenframe.llm.filter_audit import OP11_SQL, op11_filter_audit
from lumenframe.llm.hilbert import op4_hilbert
from lumenframe.llm.langid import op10_langid
from lumenframe.llm.lattice import op1_lattice
from lumenframe.llm.licences import op13_licences
from lumenframe.llm.packing import op8_packing
from lumenframe.llm.pii import op7_pii
from lumenframe.llm.quality import op3_quality
from lumenframe.llm.repair import OP12_SQL, op12_repair
from lumenframe.llm.reputation import OP5_SQL, op5_reputation
from lumenframe.llm.simhash import op2_simhash
from lumenframe.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_hilbert": op4_hilbert,
    "op5_reputation": op5_reputation,
    "op6_templates": op6_templates,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_langid": op10_langid,
    "op11_filter_audit": op11_filter_audit,
    "op12_repair": op12_repair,
    "op13_licences": op13_licences,
}

ORACLE_SQL: dict[str, str] = {"op5_reputation": OP5_SQL, "op11_filter_audit": OP11_SQL, "op12_repair": OP12_SQL}
