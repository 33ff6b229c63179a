"""Queries of this folder, by name: how to build each, and the SQL of its result where SQL can say it."""

from reelforge.llm import contamination, conversations, exact, language, licenses, lines, mixing, neighbours, packing, phrases, secrets, similar, token_files

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_language_id": language.op5_language_id,
    "op6_exact_dedup": exact.op6_exact_dedup,
    "op7_source_mixing": mixing.op7_source_mixing,
    "op8_ngram_jaccard_join": similar.op8_ngram_jaccard_join,
    "op9_token_files": token_files.op9_token_files,
    "op10_nearest_neighbours": neighbours.op10_nearest_neighbours,
    "op11_phrase_collocations": phrases.op11_phrase_collocations,
    "op12_benchmark_decontamination": contamination.op12_benchmark_decontamination,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}
SQL = {"op1_line_dedup": lines.OP1_SQL, "op2_license_scan": licenses.OP2_SQL, "op3_secret_scan": secrets.OP3_SQL, "op6_exact_dedup": exact.OP6_SQL, "op8_ngram_jaccard_join": similar.OP8_SQL,
       "op11_phrase_collocations": phrases.OP11_SQL,
       "op12_benchmark_decontamination": contamination.OP12_SQL, "op13_conversation_repair": conversations.OP13_SQL}
