"""The registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from affilspark.llm.chat import OP3_SQL, op3_chat_format
from affilspark.llm.decontaminate import op2_decontaminate
from affilspark.llm.hmm import op7_hmm_score
from affilspark.llm.language import op4_language_id
from affilspark.llm.mixing import op6_mix_sources
from affilspark.llm.periods import op12_periodic_runs
from affilspark.llm.personal import op11_personal_data
from affilspark.llm.quality import op8_quality
from affilspark.llm.ranked import OP13_SQL, op13_ranked_search
from affilspark.llm.simhash import op5_simhash_near_dedup
from affilspark.llm.substrings import OP1_SQL, op1_substring_dedup
from affilspark.llm.tokens import op10_training_order
from affilspark.llm.topk import OP9_SQL, op9_exact_top_k

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat_format": op3_chat_format,
    "op4_language_id": op4_language_id,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_hmm_score": op7_hmm_score,
    "op8_quality": op8_quality,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_training_order": op10_training_order,
    "op11_personal_data": op11_personal_data,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES = {"op1_substring_dedup": OP1_SQL, "op3_chat_format": OP3_SQL, "op9_exact_top_k": OP9_SQL, "op13_ranked_search": OP13_SQL}
