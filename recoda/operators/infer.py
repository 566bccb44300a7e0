"""Plug-in surface for user-supplied models.

The models themselves are not part of this library.  A predictor maps a list
of chats to a list of answers; an embedder maps a batch of texts to a
matrix.  Both run inside Arrow-batched Python tasks; the row key always
travels with its prompt, so outputs are joined back by key, never by position.

``first_candidate_predictor`` and ``hashed_char_embedder`` are deterministic
test doubles, not models.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, FloatType, StructType

from recoda.functions import constants as K
from recoda.session import process_object, ship_package

# a predictor answers a batch of chats (lists of {"role", "content"}): text, token ids and one log-prob per token
Chat = list[dict[str, str]]
Answer = tuple[str, list[int], list[float]]
Predictor = Callable[..., Sequence[Answer]]
Embedder = Callable[[Sequence[str]], np.ndarray]

ANSWER_SCHEMA = "output_text string, token_ids array<int>, logprobs array<double>"


def loader(kind: str, given: Callable, per_worker: bool, key: str | None = None) -> Callable[[], Callable]:
    """What a task calls to get its model: ``given`` itself, or, of a factory, what this process holds.

    A factory runs once per worker process and job, or once per process for all jobs
    that give the same ``key`` (a name for the model and its settings).
    """
    if not per_worker:
        return lambda: given
    name = key or uuid.uuid4().hex
    return lambda: process_object(kind, name, given)


def accelerator_profile(task_cpus: int = 1, **resources: float) -> ResourceProfile:
    """A resource profile for ``run_predictor`` / ``embed`` stages, e.g. ``accelerator_profile(4, gpu=1)``.

    Amounts are per task; only the stage of the model asks for them, so the stages
    around it keep all cores.  Needs a cluster manager that can give them out.
    """
    requests = TaskResourceRequests().cpus(task_cpus)
    for name, amount in resources.items():
        requests = requests.resource(name, amount)
    return ResourceProfileBuilder().require(requests).build


def chats_of(rows: pa.RecordBatch) -> list[Chat]:
    texts = zip(rows.column("__system").to_pylist(), rows.column("__user").to_pylist(), strict=True)
    return [[{"role": "system", "content": s}, {"role": "user", "content": u}] for s, u in texts]


def answered(rows: pa.RecordBatch, kept: Sequence[str], model: Predictor, options: Mapping[str, object]) -> pa.RecordBatch:
    """The kept columns of ``rows`` and the model's answers to them."""
    chats = chats_of(rows)
    outs = list(model(chats, **options)) if chats else []
    if len(outs) != len(chats):
        raise ValueError("the predictor must return one answer per prompt")
    columns = [rows.column(c) for c in kept] + [
        pa.array([o[0] for o in outs], pa.string()),
        pa.array([list(o[1]) for o in outs], pa.list_(pa.int32())),
        pa.array([list(o[2]) for o in outs], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*kept, "output_text", "token_ids", "logprobs"])


def carried(df: DataFrame, carry: Sequence[str] | None) -> list[str]:
    return list(carry) if carry is not None else [c for c in df.columns if c not in ("system_prompt", "user_prompt", "prompt")]


def with_prompts(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    return df.select(*kept, F.col("system_prompt").alias("__system"), F.col("user_prompt").alias("__user"))


def run_predictor(
    df: DataFrame,
    predictor: Predictor | Callable[[], Predictor],
    carry: Sequence[str] | None = None,
    settings: Mapping[str, object] | None = None,
    per_worker: bool = False,
    model_key: str | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """One answer per row, in Arrow batches; the carried columns travel with their prompt.

    ``df`` holds ``system_prompt`` and ``user_prompt``; the predictor is called
    with the chats (system, then user message) and the generation ``settings``
    as keywords.  With ``per_worker``, ``predictor`` is a factory that loads the
    model: a worker process calls it once and keeps the model for all its tasks
    (and for later jobs with the same ``model_key``).  ``profile``: the resources
    of this stage's tasks.  ``carry``: columns kept beside the answer (default:
    all but the prompts).
    """
    ship_package(df.sparkSession)
    kept, options = carried(df, carry), dict(settings or {})
    load = loader("predictor", predictor, per_worker, model_key)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield answered(b, kept, load(), options)

    schema = StructType(df.select(*kept).schema.fields + StructType.fromDDL(ANSWER_SCHEMA).fields)
    return with_prompts(df, kept).mapInArrow(answer, schema, profile=profile)


def char_tokens(text: str) -> list[int]:
    """Test tokenizer matching ``recoda.functions.response.text_tokens``: code points."""
    return [ord(c) for c in text]


def position_logprobs(n: int) -> list[float]:
    """Test log-probs: position p gets -(p mod 10) / 10."""
    return [-(p % 10) / 10.0 for p in range(n)]


_FIRST_CODE = re.compile(K.QUOTED_CODE_PATTERN)


def first_candidate_predictor(chats: Sequence[Chat], **settings) -> list[Answer]:
    """Test double for U2: answer the first quoted candidate code of each user message.

    It declines when a chat lacks its system message.
    """
    out = []
    for system, user in chats:
        m = _FIRST_CODE.search(user["content"] or "")
        if m and system["role"] == "system" and system["content"]:
            text = '{"codable": true, "nace2025": "' + m.group(1) + '", "nace08_valid": true}'
        else:
            text = '{"codable": false}'
        ids = char_tokens(text)
        out.append((text, ids, position_logprobs(len(ids))))
    return out


def hashed_char_embedder(dim: int = 64) -> Embedder:
    """Test double for U3: L2-normalised counts of hashed byte trigrams.

    Vectorised over the whole batch: every trigram of every text is hashed at
    once and counted with one ``bincount``; trigrams spanning two texts are
    masked out.
    """

    def embed(texts: Sequence[str]) -> np.ndarray:
        n = len(texts)
        if n == 0:
            return np.zeros((0, dim))
        enc = [f"  {(t or '').lower()} ".encode("utf-8") for t in texts]
        lens = np.fromiter((len(b) for b in enc), dtype=np.int64, count=n)
        buf = np.frombuffer(b"".join(enc), dtype=np.uint8).astype(np.uint64)
        ends = np.cumsum(lens)
        row = np.repeat(np.arange(n), lens)[: len(buf) - 2]
        pos = np.arange(len(buf) - 2)
        valid = pos + 2 < ends[row]
        tri = (buf[:-2] << np.uint64(16)) | (buf[1:-1] << np.uint64(8)) | buf[2:]
        h = ((tri * np.uint64(2654435761)) >> np.uint64(11)) % np.uint64(dim)
        flat = row[valid] * dim + h[valid].astype(np.int64)
        m = np.bincount(flat, minlength=n * dim).astype(np.float64).reshape(n, dim)
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norms > 0, norms, 1.0)

    return embed


def letter_count_embedder() -> Embedder:
    """Test double for U3: L2-normalised counts of the letters a-z in the lower-cased text.

    Simple enough to be recomputed in SQL (``length(t) - length(replace(t, c, ''))``
    per letter), which lets the retrieval prompts be checked against an oracle.
    """

    def embed(texts: Sequence[str]) -> np.ndarray:
        n = len(texts)
        if n == 0:
            return np.zeros((0, 26))
        enc = [(t or "").lower().encode("utf-8") for t in texts]
        lens = np.fromiter((len(b) for b in enc), dtype=np.int64, count=n)
        letter = np.frombuffer(b"".join(enc), dtype=np.uint8).astype(np.int64) - ord("a")
        row = np.repeat(np.arange(n), lens)
        ok = (letter >= 0) & (letter < 26)
        m = np.bincount(row[ok] * 26 + letter[ok], minlength=n * 26).astype(np.float64).reshape(n, 26)
        norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return m / np.where(norms > 0, norms, 1.0)

    return embed


def embed(
    df: DataFrame,
    text_col: str,
    embedder: Embedder | Callable[[], Embedder],
    out_col: str = "vector",
    per_worker: bool = False,
    model_key: str | None = None,
) -> DataFrame:
    """Add an ``array<float>`` embedding column, computed batch by batch.

    With ``per_worker``, ``embedder`` is a factory, called once per worker process
    (see ``run_predictor``).
    """
    load = loader("embedder", embedder, per_worker, model_key)

    @pandas_udf(ArrayType(FloatType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            m = np.asarray(load()(s.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(m))

    ship_package(df.sparkSession)
    return df.withColumn(out_col, vectors(F.col(text_col)))
