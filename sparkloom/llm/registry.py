"""The queries of this subpackage and their SQL, for the repository's entry point."""

from . import decontaminate, exact_dedup, kneser_ney, language_id, licenses, line_dedup, mixing, simhash, suffix_dedup, url_filter

MODULES = (kneser_ney, mixing, simhash, licenses, suffix_dedup, line_dedup, language_id, decontaminate, exact_dedup, url_filter)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
