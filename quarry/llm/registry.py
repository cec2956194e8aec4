"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

_MODULES = ("op01_reshard", "op02_repeats", "op03_secrets", "op04_decontaminate", "op05_bpe", "op06_toxicity", "op07_hosts", "op08_jaccard", "op09_language", "op10_exact")


def queries() -> dict:
    found = {}
    for name in _MODULES:
        module = importlib.import_module(f"{__package__}.{name}")
        found |= {k: v for k, v in vars(module).items() if k.startswith("op") and callable(v) and v.__module__ == module.__name__}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    from . import op01_reshard, op02_repeats, op07_hosts, op08_jaccard, op10_exact

    return {"op1_reshard": op01_reshard.SQL, "op2_repeated_passages": op02_repeats.SQL, "op7_host_reputation": op07_hosts.SQL, "op8_jaccard_join": op08_jaccard.SQL, "op10_exact_dedup": op10_exact.SQL}
