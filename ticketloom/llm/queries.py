"""The registered queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from ticketloom.llm.conversations import OP13_SQL, op13_structure_repair
from ticketloom.llm.decontamination import op1_decontamination
from ticketloom.llm.language_id import op8_language_id
from ticketloom.llm.near_dedup import OP3_SQL, op3_near_duplicates
from ticketloom.llm.packing import op7_best_fit_packing
from ticketloom.llm.quality import op2_weak_supervision
from ticketloom.llm.revisits import OP6_SQL, op6_revisit_resolution
from ticketloom.llm.secrets import op10_secret_scan
from ticketloom.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from ticketloom.llm.token_files import op9_token_files
from ticketloom.llm.toxicity import op5_toxicity
from ticketloom.llm.url_rules import OP11_SQL, op11_url_filter
from ticketloom.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_weak_supervision": op2_weak_supervision,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_revisit_resolution": op6_revisit_resolution,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_secret_scan": op10_secret_scan,
    "op11_url_filter": op11_url_filter,
    "op12_vector_codes": op12_vector_codes,
    "op13_structure_repair": op13_structure_repair,
}

#: The others depend on learning (2, 5, 8), on tokenizers (7, 9), on what a method adds to the contract's base
#: (10), or on template matching (1); tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op3_near_duplicates": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op6_revisit_resolution": OP6_SQL, "op11_url_filter": OP11_SQL, "op12_vector_codes": OP12_SQL, "op13_structure_repair": OP13_SQL}
