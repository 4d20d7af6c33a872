"""U1 generate, U3 failure policy, U2 judge, U4 rule-based extraction.

Model calls happen in ``mapInPandas`` on the executors: each Python worker
builds its backend once (a model or a client) and answers the rows of its
Arrow batches.  Generation is not deterministic and costly, so results are
meant to be written once (``generate_once``) and read back, never recomputed
through lineage.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom import prompt_texts as P
from graphloom.functions.prompts import expand_models, render_chat
from graphloom.session import ship_package

_BACKENDS: dict = {}


class HashBackend:
    """Deterministic offline backend: the answer is md5(prompt).  Lets every
    stage after the model run, and be checked, without a model."""

    reads_messages = False

    def generate(self, prompt: str, messages_json: str | None, options: dict) -> str:
        return hashlib.md5(prompt.encode("utf-8")).hexdigest()


class EchoBackend:
    """Answers with the prompt text itself (for plumbing tests)."""

    reads_messages = False

    def generate(self, prompt: str, messages_json: str | None, options: dict) -> str:
        return prompt


BUILTIN = {"hash": HashBackend, "echo": EchoBackend}


class JudgeBackend:
    """Deterministic offline judge for checks of the parsing and the policy:
    the first hex digit of md5(prompt) picks a score, in or out of range, or
    one of the answers that models give instead."""

    reads_messages = False

    def generate(self, prompt: str, messages_json: str | None, options: dict) -> str:
        n = int(hashlib.md5(prompt.encode("utf-8")).hexdigest()[0], 16)
        if n < 12:
            return '{"score": %.1f}' % (n / 2)
        return {12: '```json\n{"score": 3}\n```', 13: "Score: 4 of 5", 14: '{"note": 4}', 15: ""}[n]


class PickyBackend:
    """Answers like ``hash`` but fails on prompts whose md5 starts with a digit
    under ``fail_below`` (an option), for checks of the failure policy."""

    reads_messages = False

    def generate(self, prompt: str, messages_json: str | None, options: dict) -> str:
        h = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        if int(h[0], 16) < int(options.get("fail_below", 4)):
            raise ValueError("refused " + h[0])
        return h


class GraphBackend:
    """Answers with a small fenced graph named after md5(prompt); with the
    option ``echo`` the prompt comes first, as local generation returns it."""

    reads_messages = False

    def generate(self, prompt: str, messages_json: str | None, options: dict) -> str:
        h = hashlib.md5(prompt.encode("utf-8")).hexdigest()
        body = f':m_{h[:8]} a :restorationMeasure ;\n  :hasCost "{int(h[0], 16) * 1000}"^^xsd:decimal .'
        answer = f"Here is the graph:\n```turtle\n{body}\n```"
        return prompt + answer if options.get("echo") else answer


BUILTIN |= {"judge": JudgeBackend, "picky": PickyBackend, "graph": GraphBackend}


def _backend_key(spec) -> str:
    """What a backend is kept under in a worker: its name, or a digest of the
    factory's content, the same in every task."""
    if isinstance(spec, str):
        return spec
    from pyspark import cloudpickle
    return hashlib.md5(cloudpickle.dumps(spec)).hexdigest()


def _backend(spec, key: str):
    """One backend object per Python worker process and key."""
    if key not in _BACKENDS:
        _BACKENDS[key] = BUILTIN[spec]() if isinstance(spec, str) else spec()
    return _BACKENDS[key]


def generate(prompts: DataFrame, backend="hash", options: dict | None = None, keys: list[str] | None = None,
             prompt_col: str = "prompt", messages_col: str | None = "messages", on_error: str = "keep") -> DataFrame:
    """Call ``backend`` on every prompt row -> keys + response, seconds, error.

    ``backend`` is a builtin name or a zero-argument factory returning an
    object with ``generate(prompt, messages_json, options) -> str`` (a local
    model, or a client of a model server).  ``options`` (max tokens,
    temperature, top_p, repetition penalty...) are passed through.  A backend
    with ``generate_batch(prompts, messages, options) -> list`` gets an Arrow
    batch at once; if that raises, its rows are tried one by one.  The messages
    are sent as JSON beside the prompt, which holds the same text once more, unless
    a backend says that it does not read them (``reads_messages = False``).
    U3: ``on_error='keep'`` records the exception text in ``error`` and goes
    on; ``'fail'`` stops the job naming the failing row.
    """
    ship_package(prompts.sparkSession)
    opts = dict(options or {})
    keys = keys or [c for c in prompts.columns if c not in (prompt_col, messages_col)]
    reads = getattr(BUILTIN[backend] if isinstance(backend, str) else backend, "reads_messages", True)
    sel = prompts.select(*keys, prompt_col,
                         (F.to_json(messages_col) if reads and messages_col and messages_col in prompts.columns
                          else F.lit(None).cast("string")).alias("_msgs"))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields if f.name in keys)
    schema = f"{key_schema}, response string, seconds double, error string"

    name = _backend_key(backend)

    def run(batches):
        be = _backend(backend, name)
        for pdf in batches:
            resp, secs, errs = [], [], []
            if hasattr(be, "generate_batch") and len(pdf):
                t0 = time.time()
                try:
                    got = list(be.generate_batch(list(pdf.iloc[:, len(keys)]), list(pdf.iloc[:, len(keys) + 1]), opts))
                except Exception:  # noqa: BLE001 - the rows below tell which one fails
                    got = None
                if got is not None and len(got) == len(pdf):
                    out = pdf.iloc[:, :len(keys)].copy()
                    out["response"], out["seconds"], out["error"] = got, (time.time() - t0) / len(pdf), None
                    yield out
                    continue
            for row in pdf.itertuples(index=False):
                prompt, msgs = row[len(keys)], row[len(keys) + 1]
                t0 = time.time()
                try:
                    r, e = be.generate(prompt, msgs, opts), None
                except Exception as ex:  # noqa: BLE001
                    if on_error == "fail":
                        raise RuntimeError(f"generation failed for {dict(zip(keys, row[:len(keys)]))}: {ex}") from ex
                    r, e = None, f"{type(ex).__name__}: {ex}"
                resp.append(r)
                secs.append(time.time() - t0)
                errs.append(e)
            out = pdf.iloc[:, :len(keys)].copy()
            out["response"], out["seconds"], out["error"] = resp, secs, errs
            yield out

    return sel.mapInPandas(run, schema)


def path_exists(spark, path: str) -> bool:
    """Does a path exist in its own file system?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def unanswered(prompts: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Prompts that have no answer in the Parquet table at ``path`` yet: new
    ones, and those whose answers so far are errors.  A table that exists but
    cannot be read raises."""
    spark = prompts.sparkSession
    if not path_exists(spark, path):
        return prompts
    done = spark.read.parquet(path).where("error is null").select(*keys)
    return prompts.join(done, keys, "left_anti")


def latest_answers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: its answer, or its error while it has none."""
    ok = answers.where("error is null")
    return ok.unionByName(answers.where("error is not null").join(ok.select(*keys), keys, "left_anti").dropDuplicates(keys))


def generate_once(prompts: DataFrame, path: str, keys: list[str], **kw) -> DataFrame:
    """U1 with a lineage cut: answer only prompts without an answer in the
    Parquet table at ``path`` (resume after a failure; rows that failed are
    tried again), append them, and return the table read back, one row per
    key.  A retried task or a second action never calls the model again for
    answers already saved."""
    spark = prompts.sparkSession
    generate(unanswered(prompts, path, keys), keys=keys, **kw).write.mode("append").parquet(path)
    return latest_answers(spark.read.parquet(path), keys)


def generate_sweep(docs: DataFrame, models: list[str], ask, path: str, keys: list[str], **kw) -> DataFrame:
    """``generate_once`` over every document x every model, where ``ask(docs,
    models)`` makes the prompts (``expand_models`` takes the models as a list or as
    a column).  A resumed run finds what is unanswered by keys alone and takes each
    document once, with the models it lacks: the prompts, several times the texts,
    are made after that join and not moved by it."""
    spark = docs.sparkSession
    rows = [k for k in keys if k != "model"]
    prompts = ask(docs, models)
    if path_exists(spark, path):
        todo = unanswered(expand_models(docs.select(*rows), models), path, keys).groupBy(*rows).agg(F.collect_set("model").alias("_models"))
        todo = todo.select(*[F.col(k).alias(f"_{k}") for k in rows], "_models")
        same = [docs[k].eqNullSafe(todo[f"_{k}"]) for k in rows]
        prompts = ask(docs.join(todo, same, "inner"), F.col("_models"))
    generate(prompts.select(*keys, *[c for c in prompts.columns if c in ("prompt", "messages")]), keys=keys, **kw) \
        .write.mode("append").parquet(path)
    return latest_answers(spark.read.parquet(path), keys)


def judge_prompts(graphs: DataFrame, docs: DataFrame, graph_col: str = "turtle",
                  criteria: list[str] | None = None) -> DataFrame:
    """U2 (prompt side): one judge prompt per (graph, criterion): system text
    with the criterion, user turn = source text + graph."""
    crit = criteria or P.JUDGE_CRITERIA
    j = graphs.join(docs.select("doc_id", "text"), "doc_id")
    j = j.withColumn("criterion", F.explode(F.array(*[F.lit(c) for c in crit])))
    head, tail = P.JUDGE_SYSTEM.split("{criterion}")
    system = F.concat(F.lit(head), F.col("criterion"), F.lit(tail.replace("{{", "{").replace("}}", "}")))
    user = F.concat(F.lit("Text:\n"), F.col("text"), F.lit("\n\nGraph:\n"), F.col(graph_col))
    msgs = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))
    return j.withColumn("messages", msgs).withColumn("prompt", render_chat("messages", True)).drop("text")


FENCES = r"(?s)^\s*```[A-Za-z]*\s*\n(.*?)\n\s*```\s*$"


def parse_score(response: str = "response"):
    """U2 (answer side): struct(score, status) from the strict JSON answer
    ``{"score": x}`` with x from 0 to 5, code fences removed.  Everything else
    has no score and says why: empty | not_json | no_score | out_of_range."""
    raw = F.trim(F.coalesce(F.col(response), F.lit("")))
    body = F.when(raw.rlike(FENCES), F.regexp_extract(raw, FENCES, 1)).otherwise(raw)
    text = F.get_json_object(body, "$.score")
    x = text.try_cast("double")
    is_json = F.try_parse_json(body).isNotNull() & F.trim(body).startswith("{")
    status = (F.when(body == "", "empty").when(~is_json, "not_json").when(x.isNull() | F.isnan(x), "no_score")
              .when((x < 0) | (x > 5), "out_of_range").otherwise("ok"))
    return F.struct(F.when(status == "ok", x).alias("score"), status.alias("status"))


def judge(graphs: DataFrame, docs: DataFrame, backend="hash", keys: list[str] | None = None,
          graph_col: str = "turtle", criteria: list[str] | None = None) -> DataFrame:
    """Judge prompts -> U1 -> score per (graph keys, criterion)."""
    keys = keys or ["regime", "model", "doc_id"]
    pr = judge_prompts(graphs, docs, graph_col, criteria).select(*keys, "criterion", "prompt", "messages")
    ans = generate(pr, backend=backend, keys=[*keys, "criterion"])
    s = parse_score()
    return ans.withColumn("score", s["score"]).withColumn("score_status", s["status"])
