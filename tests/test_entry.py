"""The entry survives whatever the corpus operators cannot import; folders are shared or refused."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]


@pytest.mark.parametrize("missing", ["ahocorasick", "millrace.llm", "corpus_pipeline"])
def test_queries_without_something_the_corpus_operators_need(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from millrace import shared

    class Conf:
        def get(self, name, default=None):
            return default

    class Off:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

            class _jsc:  # noqa: N801
                @staticmethod
                def sc():
                    class Context:
                        @staticmethod
                        def getCheckpointDir():
                            class Nothing:
                                @staticmethod
                                def isDefined():
                                    return False

                            return Nothing

                    return Context

    with pytest.raises(RuntimeError):
        shared.shared_dir(Off, "x")
    assert shared.shared_dir(spark, "x") != shared.shared_dir(spark, "x")
