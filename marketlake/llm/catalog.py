"""Registered queries of the training-data operators and their SQL oracles."""

from marketlake.llm.ann import op4_nearest_neighbours
from marketlake.llm.chat import OP5_SQL, op5_chat_format
from marketlake.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from marketlake.llm.hmm import op7_hmm_scores
from marketlake.llm.langid import op10_language_id
from marketlake.llm.mixing import OP8_SQL, op8_mixing
from marketlake.llm.packing import op1_best_fit_packing
from marketlake.llm.periodic import op11_periodic_runs
from marketlake.llm.phrases import OP13_SQL, op13_phrases
from marketlake.llm.pii import op12_personal_data
from marketlake.llm.quality import op9_quality
from marketlake.llm.secrets import op3_secret_scan
from marketlake.llm.simhash import op2_simhash

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_simhash": op2_simhash,
    "op3_secret_scan": op3_secret_scan,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_chat_format": op5_chat_format,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_hmm_scores": op7_hmm_scores,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_personal_data": op12_personal_data,
    "op13_phrases": op13_phrases,
}

#: the other operators have no SQL form: tests/llm holds brute-force versions of them
ORACLE = {"op5_chat_format": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op8_mixing": OP8_SQL, "op13_phrases": OP13_SQL}
