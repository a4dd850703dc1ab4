"""Registry of the subpackage: query name -> callable, and the SQL where SQL can say it."""

from __future__ import annotations

from .conversation_repair import OP12_SQL, op12_conversation_repair
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .filter_audit import OP13_SQL, op13_filter_audit
from .jaccard_join import op9_jaccard_join
from .language_id import op3_language_id
from .license_scan import OP10_SQL, op10_license_scan
from .line_dedup import OP11_SQL, op11_line_dedup
from .lm_score import op6_lm_score
from .mixing import op8_mixing
from .sentencepiece_ids import op5_sentencepiece
from .simhash import op1_simhash
from .suffix_dedup import op2_suffix_dedup
from .toxicity import op7_toxicity


def pipeline(spark, sf_dir: str):
    """All stages of corpus_pipeline.py, which stands beside the package."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_lm_score": op6_lm_score,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_license_scan": op10_license_scan,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op4_exact_dedup": OP4_SQL,
    "op10_license_scan": OP10_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
