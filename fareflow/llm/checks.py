"""The registered queries of this subpackage and the SQL they must equal."""

from fareflow.llm import chat, decontaminate, language, line_dedup, lm, near_dedup, neighbours, packing, prefix_trie, resampling, secrets, token_files, urls

MODULES = (secrets, decontaminate, chat, near_dedup, language, packing, urls, line_dedup, lm, neighbours, token_files, prefix_trie, resampling)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
