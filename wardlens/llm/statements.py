"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

from wardlens.llm import decontamination, exact_topk, mixing

SQL: dict[str, str] = {
    "op7_exact_topk": exact_topk.statement(),
    "op8_source_mix": mixing.statement(),
    "op13_decontamination": decontamination.statement(),
}
