"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from conftest import ROOT
from lotguard.plans.queries import QUERIES


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_contract(spark):
    mod = _entry()
    df = mod.entry(spark)
    assert df.columns == ["item_id", "lote_id", "regra_violada", "descricao_do_erro", "acao_recomendada",
                          "severidade"]
    assert df.count() == 660
    q, sql = mod.queries(), mod.oracle_sql()
    own = set(q) - set(mod.LLM_QUERIES)
    assert own == set(QUERIES) and own <= set(sql) and set(sql) <= set(q)


def test_core_stays_without_the_optional_part(spark, monkeypatch):
    import builtins

    real = builtins.__import__

    def broken(name, *args, **kwargs):
        if name == "corpus_pipeline" or name.startswith("zstandard"):
            raise ImportError(f"no {name}")
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", broken)
    mod = _entry()
    assert mod.LLM_MISSING is not None and set(mod.queries()) == set(QUERIES)
