"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from corpusloom.llm.decontamination import SQL as DECONTAMINATION_SQL, op2_decontamination
from corpusloom.llm.embeddings import op4_embeddings
from corpusloom.llm.html_text import op5_html
from corpusloom.llm.language_id import op1_language_id
from corpusloom.llm.mixing import op10_mixing
from corpusloom.llm.sharding import SQL as SHARDING_SQL, op3_sharding
from corpusloom.llm.simhash import op8_simhash
from corpusloom.llm.token_counts import op9_token_counts
from corpusloom.llm.toxicity import op6_toxicity
from corpusloom.llm.warc import SQL as WARC_SQL, op7_warc

QUERIES = {
    "op1_language_id": op1_language_id, "op2_decontamination": op2_decontamination, "op3_sharding": op3_sharding, "op4_embeddings": op4_embeddings,
    "op5_html": op5_html, "op6_toxicity": op6_toxicity, "op7_warc": op7_warc, "op8_simhash": op8_simhash, "op9_token_counts": op9_token_counts, "op10_mixing": op10_mixing,
}
ORACLES = {"op2_decontamination": DECONTAMINATION_SQL, "op3_sharding": SHARDING_SQL, "op7_warc": WARC_SQL}
