"""Name -> query of this subpackage, and the SQL that must give the same rows where SQL can express it."""

from wayfare.llm.archives import OP12_SQL, op12_warc_archives
from wayfare.llm.audit import OP13_SQL, op13_filter_audit
from wayfare.llm.caps import op4_embedding_dedup
from wayfare.llm.licenses import op7_license_scan
from wayfare.llm.main_text import op3_main_text
from wayfare.llm.minhash import op5_minhash_dedup
from wayfare.llm.mixing import OP1_SQL, op1_mix_sources
from wayfare.llm.packing import op2_best_fit_packing
from wayfare.llm.periods import op11_periodic_runs
from wayfare.llm.pii import op10_pii
from wayfare.llm.quality import op9_quality_rules
from wayfare.llm.token_files import op6_token_files
from wayfare.llm.urls import op8_url_filter

QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_best_fit_packing, op3_main_text, op4_embedding_dedup, op5_minhash_dedup, op6_token_files, op7_license_scan, op8_url_filter, op9_quality_rules, op10_pii,
    op11_periodic_runs, op12_warc_archives, op13_filter_audit,
)}
ORACLES = {"op1_mix_sources": OP1_SQL, "op12_warc_archives": OP12_SQL, "op13_filter_audit": OP13_SQL}
