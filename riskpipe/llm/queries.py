"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from functools import wraps

from riskpipe.llm import common, hard_negatives, mixing, near_dups, ngram_join, outliers
from riskpipe.llm.ann import op6_cross_polytope
from riskpipe.llm.bpe_tree import op4_tree_bpe
from riskpipe.llm.hard_negatives import op11_l2ap_negatives
from riskpipe.llm.mixing import op7_pareto_mix
from riskpipe.llm.near_dups import op10_fast_sketch_dedup
from riskpipe.llm.ngram_join import op12_divide_skip_join
from riskpipe.llm.outliers import op1_mcd_quality
from riskpipe.llm.pii import op5_pii
from riskpipe.llm.pitman_yor import op8_pitman_yor
from riskpipe.llm.quality import op9_nbsvm_quality
from riskpipe.llm.token_files import op2_token_files
from riskpipe.llm.toxicity import op3_toxic_segments
from riskpipe.llm.whitening import op13_bit_sliced_whitening


def _with_package(query):
    """The query, after the executors have been given this package."""
    @wraps(query)
    def run(spark, sf_dir):
        common.ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {name: _with_package(query) for name, query in {
    "op1_mcd_quality": op1_mcd_quality,
    "op2_token_files": op2_token_files,
    "op3_toxic_segments": op3_toxic_segments,
    "op4_tree_bpe": op4_tree_bpe,
    "op5_pii": op5_pii,
    "op6_cross_polytope": op6_cross_polytope,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_nbsvm_quality": op9_nbsvm_quality,
    "op10_fast_sketch_dedup": op10_fast_sketch_dedup,
    "op11_l2ap_negatives": op11_l2ap_negatives,
    "op12_divide_skip_join": op12_divide_skip_join,
    "op13_bit_sliced_whitening": op13_bit_sliced_whitening,
}.items()}
#: The others: files, learned models, tokenizers and approximate search, held against plain versions in tests.
ORACLE: dict[str, str] = {
    "op1_mcd_quality": outliers.ORACLE_SQL,
    "op7_pareto_mix": mixing.ORACLE_SQL,
    "op10_fast_sketch_dedup": near_dups.ORACLE_SQL,
    "op11_l2ap_negatives": hard_negatives.ORACLE_SQL,
    "op12_divide_skip_join": ngram_join.ORACLE_SQL,
}
