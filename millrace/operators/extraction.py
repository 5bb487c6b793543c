"""Extraction by language models: prompts, a provider protocol, a chain of providers, merging of chunks."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import parsed_reply
from ..functions.text import CHARS_PER_TOKEN
from ..retry import HTTP, Retry
from ..schemas import CONTENT, violations
from ..shared import kept
from .storage import Table

ASK = {
    "STARTUP": "Name the company and say what it does, where, since when and with how many people.",
    "PRODUCT": "Name the product, its maker, its price model, its website and what it is for.",
    "RESEARCH_PAPER": "Give title, authors, abstract, date and code repository of the paper.",
    "JOB": "Give employer, role, place, date, pay and whether the job is remote.",
    "NEWS": "Give headline, body, author and date of the article.",
}


_ANSWER = "Answer with one JSON object of the fields: {schema}.\nUse null for what is not there.\n\nText:\n{text}"
#: Requests with the places ``{schema}``, ``{text}``, ``{name}``, ``{candidates}``, ``{number}`` and ``{of}``.
TEMPLATES = {
    **{k: f"{v}\n{_ANSWER}" for k, v in ASK.items()},
    "GENERAL": f"Take from the text what the fields below ask for, and nothing that it does not say.\n{_ANSWER}",
    "CHUNK": f"This is part {{number}} of {{of}} of a long text; other parts are read by others. Take only what this part says.\n{_ANSWER}",
    "RESOLVE": "Which of the known names is meant by the name below? Legal forms, case and punctuation make no difference; if none fits, "
    "repeat the name with a low confidence.\nAnswer with one JSON object of the fields: canonical_name string, confidence double, reason string.\n\nName:\n{name}\nKnown names:\n{candidates}",
}


def filled(template: Column | str, **values: Column) -> Column:
    """A template with its places filled, each once, in one go: what is filled in is not looked at again."""
    out = F.lit(template) if isinstance(template, str) else template
    parts = F.split(out, r"(?=\{(?:schema|text|name|candidates|number|of)\})")
    known = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))])

    def fill(part: Column) -> Column:
        name = F.regexp_extract(part, r"^\{([a-z]+)\}", 1)
        value = F.try_element_at(known, name)
        return F.when(value.isNull(), part).otherwise(F.concat(value, F.substr(part, F.length(name) + 3)))

    return F.array_join(F.transform(parts, fill), "")


def prompt(record_type: Column, text: Column, template: str | None = None) -> Column:
    """The request for a text: what to find, the fields to answer with, the text.  Unknown types ask as news; a
    ``template`` of one's own takes the place of the type's."""
    schemas = F.create_map(*[F.lit(x) for kv in CONTENT.items() for x in kv])
    schema = F.coalesce(F.try_element_at(schemas, record_type), F.try_element_at(schemas, F.lit("NEWS")))
    asks = F.create_map(*[F.lit(x) for k in ASK for x in (k, TEMPLATES[k])])
    own = F.lit(template) if template else F.coalesce(F.try_element_at(asks, record_type), F.try_element_at(asks, F.lit("NEWS")))
    return filled(own, schema=schema, text=text)


def chunk_prompt(record_type: Column, text: Column, number: Column, of: Column) -> Column:
    schemas = F.create_map(*[F.lit(x) for kv in CONTENT.items() for x in kv])
    return filled(TEMPLATES["CHUNK"], schema=F.try_element_at(schemas, record_type), text=text, number=number, of=of)


def resolution_prompt(name: Column, candidates: Column) -> Column:
    """``candidates``: an array of known names, listed one a line."""
    return filled(TEMPLATES["RESOLVE"], name=name, candidates=F.array_join(candidates, "\n"))


class Provider(Protocol):
    """Answers prompts in batches; an answer may be None, an error is a string that begins with ``!``."""

    name: str

    def answer(self, prompts: list[str]) -> list[str | None]: ...


class Echo:
    """Offline stand-in: answers with the first line of the text as the title, in JSON."""

    name = "echo"

    def answer(self, prompts: list[str]) -> list[str | None]:
        return [json.dumps({"title": (p.split("Text:\n", 1)[-1].strip().splitlines() or [""])[0][:80], "body": p.split("Text:\n", 1)[-1]}) for p in prompts]


class ProviderError(Exception):
    """An error with the name that is reported for it."""

    retry_after: float | None = None


class RateLimitError(ProviderError):
    pass


class PayloadTooLargeError(ProviderError):
    pass


class ProviderUnavailableError(ProviderError):
    pass


def http_post(url: str, headers: dict[str, str], body: dict, timeout: float) -> tuple[int, dict[str, str], str]:
    import json
    import urllib.error
    import urllib.request

    asked = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    try:
        with urllib.request.urlopen(asked, timeout=timeout) as r:
            return r.status, dict(r.headers), r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read().decode(errors="replace")


@dataclass
class ChatService:
    """A model behind the usual chat-completions interface.  ``post`` is how requests are sent."""

    url: str
    model: str
    key: str = ""
    name: str = "chat"
    timeout: float = 120.0
    input_tokens: int = 32_000
    output_tokens: int = 4_096
    retry: Retry = HTTP
    post: Callable[[str, dict[str, str], dict, float], tuple[int, dict[str, str], str]] = http_post
    wait: Callable[[float], None] = time.sleep

    def chat(self, messages: list[dict[str, str]], temperature: float = 0.0) -> str:
        """The reply to a conversation; an error of its own name after the last attempt."""
        body = {"model": self.model, "messages": messages, "temperature": temperature, "max_tokens": self.output_tokens}
        status, headers, text = self.post(f"{self.url}/chat/completions", {"Authorization": f"Bearer {self.key}"}, body, self.timeout)
        if status == 429:
            error = RateLimitError("too many requests")
            error.retry_after = float(headers.get("Retry-After", 60))
            raise error
        if status == 413:
            raise PayloadTooLargeError(f"too large for {self.model}")
        if status != 200:
            raise ProviderUnavailableError(f"status {status}")
        return json.loads(text)["choices"][0]["message"]["content"]

    def one(self, prompt: str) -> str:
        try:
            if len(prompt) // CHARS_PER_TOKEN > self.input_tokens:
                raise PayloadTooLargeError(f"more than {self.input_tokens} tokens")
            return self.retry.call(self.chat, [{"role": "user", "content": prompt}], wait=self.wait, fatal=(PayloadTooLargeError,))
        except Exception as e:  # noqa: BLE001  the chain goes on with the next provider
            return f"!{type(e).__name__}: {e}"

    def answer(self, prompts: list[str]) -> list[str | None]:
        return [self.one(p) for p in prompts]


_REPLY = T.StructType([T.StructField(c, T.StringType()) for c in ("provider", "reply", "error")])


def _asked(prompts: list[str], providers: list[Provider]) -> list[dict]:
    """The first provider of the chain that answers each prompt; the last error if none does."""
    out: list[dict] = [{"provider": None, "reply": None, "error": None} for _ in prompts]
    for p in providers:
        left = [i for i, o in enumerate(out) if o["reply"] is None]
        if not left:
            break
        for i, reply in zip(left, p.answer([prompts[i] for i in left]), strict=True):
            if reply is None or reply.startswith("!"):
                out[i]["error"] = (reply or "!no answer")[1:]
            else:
                out[i] = {"provider": p.name, "reply": reply, "error": None}
    return out


def answers(rows: DataFrame, prompts: str, providers: list[Provider], replies: "Replies | None" = None) -> DataFrame:
    """Adds ``provider``, ``reply`` and ``error``: the first provider of the chain that answers; the last
    error if none does.  With ``replies`` each distinct prompt is asked once, whatever is run again."""
    if replies is not None:
        return replies.answered(rows, prompts, providers)

    def run(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_asked(list(x), providers), columns=_REPLY.names)

    run.__annotations__ = {"x": pd.Series, "return": pd.DataFrame}
    return rows.withColumn("a", F.pandas_udf(run, _REPLY).asNondeterministic()(F.col(prompts))).select("*", "a.*").drop("a")


@dataclass
class Replies:
    """Replies kept by the hash of prompt, models and temperature, so that a prompt is asked, and paid for, once.

    A task sends its prompts in groups of ``together`` and, after each group, gives what was answered to a ledger: a folder where one file
    appears under its final name at once, named by the group's hash.  A task that runs again, or beside itself, finds the groups that are in the
    ledger and asks only for the others; a group that was under way when a task ended is asked again, no more than that.  When all tasks
    are through, the ledger is put into a stored table by key, against which later runs join before anything is asked, and is emptied.  Errors are not
    kept: they are asked again by the next run.

    ``path`` is in a folder that all executors share: a path, or an address of a store that Arrow's file systems reach."""

    spark: SparkSession
    path: str
    temperature: float = 0.0
    together: int = 16

    @property
    def table(self) -> Table:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "provider", "reply")])
        return Table(self.spark, f"{self.path}/table", schema, ["key"], ["provider"])

    def _ledger(self) -> str:
        return f"{self.path if '://' in self.path else 'file://' + self.path.removeprefix('file:')}/ledger"

    def key(self, prompt: Column, providers: list[Provider]) -> Column:
        models = json.dumps([[p.name, getattr(p, "model", "")] for p in providers])
        return F.sha2(F.concat_ws("\x1f", F.lit(models), F.lit(str(self.temperature)), prompt), 256)

    def _settle(self) -> None:
        """What finished groups of earlier runs left in the ledger goes into the table."""
        store, folder = stores.FileSystem.from_uri(self._ledger())
        found = sorted(f.path for f in store.get_file_info(stores.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".json"))
        if found:
            root = self._ledger()
            self.table.put(self.spark.read.schema(self.table.schema).json([f"{root}/{f.rsplit('/', 1)[1]}" for f in found]))
            for f in found:
                store.delete_file(f)

    def answered(self, rows: DataFrame, prompts: str, providers: list[Provider]) -> DataFrame:
        self._settle()
        store, folder = stores.FileSystem.from_uri(self._ledger())
        store.create_dir(folder)
        keyed = kept(rows.withColumn("__key", F.when(F.col(prompts).isNotNull(), self.key(F.col(prompts), providers))), "prompts")
        open_ = keyed.where("__key is not null").groupBy(F.col("__key").alias("key")).agg(F.first(prompts).alias("prompt")).join(self.table.read(), "key", "left_anti")
        # Written, so that the groups of a task are the same when it runs again.
        open_ = kept(open_.repartition(_parts(self.spark), "key").sortWithinPartitions("key"), "asked")
        made = kept(open_.mapInArrow(_through(self._ledger(), self.together, providers), "key string, provider string, reply string, error string"), "replies")
        self._settle()
        known = self.table.read().withColumn("error", F.lit(None).cast("string")).unionByName(made.where("reply is null"))
        return keyed.join(known.withColumnRenamed("key", "__key"), "__key", "left").drop("__key")


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _through(ledger: str, together: int, providers: list[Provider]):
    def run(batches):
        store, folder = stores.FileSystem.from_uri(ledger)
        for batch in batches:
            keys, prompts = batch.column("key").to_pylist(), batch.column("prompt").to_pylist()
            for a in range(0, len(keys), together):
                group = keys[a : a + together]
                name = f"{folder}/{hashlib.sha256(','.join(group).encode()).hexdigest()}.json"
                if store.get_file_info(name).type != stores.FileType.NotFound:
                    with store.open_input_stream(name) as f:
                        said = [json.loads(x) for x in f.read().decode().splitlines()]
                else:
                    said = [{"key": k, **r} for k, r in zip(group, _asked(prompts[a : a + together], providers), strict=True)]
                    good = [json.dumps({c: r[c] for c in ("key", "provider", "reply")}) for r in said if r["reply"] is not None]
                    made = f"{folder}/.{uuid.uuid4().hex}"
                    with store.open_output_stream(made) as f:
                        f.write("\n".join(good).encode())
                    store.move(made, name)
                have = {r["key"]: r for r in said}
                out = [have.get(k, {}) for k in group]
                yield pa.record_batch({"key": pa.array(group), **{c: pa.array([r.get(c) for r in out], pa.string()) for c in ("provider", "reply", "error")}})

    return run


def validated(rows: DataFrame, reply: str, record_type: str) -> DataFrame:
    """Adds ``content``, the reply as the record type's struct (fields of another kind are null), and ``violations``,
    the fields that break a rule; ``["reply"]`` where there is no JSON object in it."""
    fields = [f.strip().split(" ") for f in CONTENT[record_type].split(", ")]
    packed = rows.select(F.struct("*").alias("__row"), parsed_reply(F.col(reply)).alias("__v"))

    def value(name: str, kind: str) -> Column:
        got = F.try_variant_get("__v", f"$.{name}", kind)
        if kind != "string":
            return got
        return F.when(F.schema_of_variant(F.try_variant_get("__v", f"$.{name}", "variant")) == "STRING", got)  # an array or object is no text

    content = F.struct(*[value(name, kind).alias(name) for name, kind in fields])
    found = packed.select("__row", F.when(F.startswith(F.schema_of_variant("__v"), F.lit("OBJECT")), content).alias("content"))
    wrong = F.when(F.col("content").isNull(), F.array(F.lit("reply"))).otherwise(violations(record_type))
    return found.select("__row", "content", "content.*").select("__row.*", "content", wrong.alias("violations"))


def settled(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``answers`` and ``validated`` made, as good rows and dead letters; those say why, in ``reason``."""
    bad = F.col("reply").isNull() | (F.size("violations") > 0)
    reason = F.when(F.col("reply").isNull(), F.coalesce("error", F.lit("no answer"))).otherwise(F.concat(F.lit("invalid: "), F.array_join("violations", ", ")))
    return found.where(~bad), found.where(bad).withColumn("reason", reason)
