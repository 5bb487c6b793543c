"""Each prompt is asked, and paid for, once: over retried tasks, runs that end early and later runs."""

import os
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

from millrace.operators import extraction

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


class Counting:
    """Notes every prompt it is asked in a folder; dies once in the middle of a task if it is told to."""

    name, model = "counting", "m1"

    def __init__(self, folder, dies=False, fails=()):
        self.folder, self.dies, self.fails = str(folder), dies, fails

    def answer(self, prompts):
        out = []
        for p in prompts:
            if self.dies and p == "p13" and not (Path(self.folder) / "died").exists():
                (Path(self.folder) / "died").touch()
                os._exit(7)  # the worker is gone, as with a lost executor
            with open(f"{self.folder}/asked", "a") as f:
                f.write(p + "\n")
            out.append("!busy" if p in self.fails else f"reply to {p}")
        return out

    def asked(self):
        at = Path(self.folder) / "asked"
        return at.read_text().split() if at.exists() else []


def prompts(spark, n=30):
    return spark.createDataFrame([(i, f"p{i % 20}" if i else None) for i in range(n)], "id int, prompt string")


def replies(spark, tmp_path, together=4):
    return extraction.Replies(spark, str(tmp_path / "replies"), together=together)


def test_each_distinct_prompt_is_asked_once_and_never_again(spark, tmp_path):
    model = Counting(tmp_path)
    for _ in range(2):
        got = {r["id"]: (r["provider"], r["reply"], r["error"]) for r in extraction.answers(prompts(spark), "prompt", [model], replies(spark, tmp_path)).collect()}
        assert got == {i: ("counting", f"reply to p{i % 20}", None) if i else (None, None, None) for i in range(30)}
    assert sorted(model.asked()) == sorted(f"p{i}" for i in range(20))
    other = Counting(tmp_path)
    other.model = "m2"  # another model is another question
    extraction.answers(prompts(spark), "prompt", [other], replies(spark, tmp_path)).collect()
    assert len(model.asked()) == 40


def test_a_run_that_dies_half_way_asks_no_finished_prompt_again(spark, tmp_path):
    """Local tasks are not tried again, so the first run ends with the worker; the second finds what was answered."""
    model, kept = Counting(tmp_path, dies=True), replies(spark, tmp_path, together=1)
    with pytest.raises(Exception):  # noqa: B017  however Spark names the lost worker
        extraction.answers(prompts(spark), "prompt", [model], kept).collect()
    before = model.asked()
    assert 0 < len(before) < 20 and "p13" not in before
    got = [r["reply"] for r in extraction.answers(prompts(spark), "prompt", [model], kept).collect()]
    assert sum(r is not None for r in got) == 29
    assert sorted(model.asked()) == sorted(f"p{i}" for i in range(20))
    assert not [f for f in (tmp_path / "replies" / "ledger").iterdir() if f.suffix == ".json"]


def test_errors_are_asked_again(spark, tmp_path):
    first, later = Counting(tmp_path, fails=("p3",)), Counting(tmp_path)
    rows = {r["id"]: r for r in extraction.answers(prompts(spark), "prompt", [first], replies(spark, tmp_path)).collect()}
    assert rows[3]["error"] == "busy" and rows[23]["error"] == "busy" and rows[4]["error"] is None
    rows = {r["id"]: r for r in extraction.answers(prompts(spark), "prompt", [later], replies(spark, tmp_path)).collect()}
    assert rows[3]["reply"] == "reply to p3" and later.asked().count("p3") == 2 and later.asked().count("p4") == 1


def test_replies_of_nothing(spark, tmp_path):
    assert extraction.answers(prompts(spark, 0), "prompt", [Counting(tmp_path)], replies(spark, tmp_path)).count() == 0


class Judge:
    """Answers which known name is meant, as a model would; notes what it was asked."""

    name, model = "judge", "j"

    def __init__(self, folder, says):
        self.folder, self.says = str(folder), says

    def answer(self, prompts):
        import json

        out = []
        for p in prompts:
            raw = p.split("Name:\n")[1].split("\nKnown names:")[0]
            with open(f"{self.folder}/judged", "a") as f:
                f.write(raw + "\n")
            said = self.says.get(raw)
            out.append("no idea" if said is None else "```json\n" + json.dumps({"canonical_name": said[0], "confidence": said[1], "reason": "r"}) + "\n```")
        return out


def test_names_between_review_and_acceptance_are_asked_about_once(spark, tmp_path):
    from millrace.operators import resolution

    aliases = resolution.alias_table(spark.createDataFrame([], "raw string, canonical string, seq int"))
    names = spark.createDataFrame([(1, "Nvidea"), (2, "nvidea"), (3, "Microsaft Corp"), (4, "Gooogle"), (5, "Amzon"), (6, "Unlike"), (7, "Apple")], "name_id int, raw string")
    known = spark.createDataFrame([(1, "Nvidia"), (2, "Nvidra"), (3, "Microsoft"), (4, "Google"), (5, "Amazon"), (6, "Apple Inc.")], "candidate_id int, candidate string")
    judge = Judge(tmp_path, {"Nvidea": ("Nvidia", 0.9), "Microsaft Corp": ("Microsoft", 0.5), "Gooogle": ("Alphabet", 0.99), "Amzon": None})
    for _ in range(2):
        rows = resolution.resolved(names, aliases, known, providers=[judge], replies=replies(spark, tmp_path)).collect()
        got = {r["name_id"]: (r["canonical"], r["method"], r["confidence"], r["needs_review"]) for r in rows}
        assert got == {
            1: ("Nvidia", "llm", 0.9, False), 2: ("Nvidia", "llm", 0.9, False), 3: ("microsaft", "exact", 0.7, False), 4: ("gooogle", "exact", 0.7, False),
            5: ("amzon", "exact", 0.7, True), 6: ("unlike", "exact", 0.7, False), 7: ("Apple Inc.", "exact", 1.0, False),
        }
    assert sorted((tmp_path / "judged").read_text().splitlines()) == ["Amzon", "Gooogle", "Microsaft Corp", "Nvidea"]
