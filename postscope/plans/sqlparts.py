"""DuckDB SQL fragments used by the oracle statements (same semantics as the
Spark expressions, written independently in SQL)."""

from __future__ import annotations

from collections.abc import Sequence

from ..vocab import STOP_WORDS

NON_WORD = r"\W+"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_dominant_tag(col: str, tags: Sequence[str]) -> str:
    counts = [f"((length({col}) - length(replace({col}, {sql_str(t)}, ''))) // {len(t)})" for t in tags]
    best = f"greatest({', '.join(counts)})"
    whens = " ".join(f"WHEN {c} = {best} THEN {sql_str(t)}" for c, t in zip(counts, tags))
    return f"(CASE {whens} ELSE {sql_str(tags[0])} END)"


def sql_tokens(col: str) -> str:
    return f"string_split_regex(lower({col}), '{NON_WORD}')"


def sql_stop_list() -> str:
    return ", ".join(sql_str(w) for w in STOP_WORDS)


def sql_words_per_post(col: str) -> str:
    """Java split count, NULL where no row is emitted."""
    n = f"len(string_split_regex(regexp_replace(lower({col}), '\\W+$', ''), '{NON_WORD}'))"
    return f"(CASE WHEN regexp_matches(lower({col}), '\\w') OR {col} = '' THEN CAST({n} AS INTEGER) END)"


def sql_utf16_length(col: str) -> str:
    n = f"(length({col}) + length(regexp_replace({col}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    return f"(CASE WHEN {n} > 0 THEN CAST({n} AS INTEGER) END)"


def sql_max_word_length(col: str) -> str:
    m = f"list_max(list_transform({sql_tokens(col)}, lambda w: length(w)))"
    return f"(CASE WHEN {m} > 0 THEN CAST({m} AS INTEGER) END)"


def sql_int(expr: str) -> str:
    """Truncating double -> int (DuckDB's plain cast rounds)."""
    return f"CAST(trunc({expr}) AS INTEGER)"


def sql_k() -> str:
    return "coalesce(TRY_CAST(json_extract(props, '$.k') AS INTEGER), 0)"
