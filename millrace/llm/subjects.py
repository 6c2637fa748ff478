"""Subject areas of documents (problem 10).

A latent Dirichlet topic model is fitted to all documents by distributed
variational EM: topics' term weights are sent to the tasks, each task infers
its documents' topic proportions and returns expected counts, which Spark
sums.  Terms are hashed, so the model's size has a bound however large the
corpus.  The topics start from the short example texts of each subject, with
one topic for what is common to all; they learn the subjects' other terms
from the documents.  Topics are mapped to subjects by the examples' weight
among their top terms, and a document gets the subjects that its sentences'
topic proportions are about.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ngrams import coarse
from millrace.plans.lineage import materialise

#: Size of the hashed vocabulary.
TERM_BITS = 18
#: Terms in fewer documents are left out, but for those of the examples: names and slips.
LEAST_DOCS = 15
#: Documents inferred at once, and columns of the model that are summed together.
SLICE, BLOCK = 2000, 8192
#: Rounds of EM over the corpus, and of inference within a document.
ROUNDS, INNER = 5, 4
#: Dirichlet parameters of documents (subject, common topic) and of topics.
ALPHA, ALPHA_COMMON, ETA = 0.05, 0.5, 0.01
#: Share of a document's sentences that must be about a subject, and the expected number of its terms in such a sentence.
LEAST_SENTENCES, LEAST_TERMS = 0.25, 0.7
#: Terms speak for a subject only if so much of their occurrences in the corpus belongs to one.
PURITY = 0.6

_TERM = r"[一-鿿々〆ヶ]+|[ァ-ヺー]{2,}|[a-zß-öø-ɏ]{3,}|[Ͱ-Ͽ]{3,}|[Ѐ-ԯ]{3,}|[가-힣]{2,}|[\u0590-\u06ff]{2,}|[\u0900-\u0fff]{3,}"
#: A sentence ends after an end mark that no closing bracket follows, after a Latin word's full stop, and at line ends.
_END = r"(?:[。!?](?![」』）)])|(?<=[a-zß-öø-ɏͰ-ԯ0-9)\"”])\.(?=\s)|\n)[\s。!?]*"
_TERMS = re.compile(_TERM)
_TOKENS = re.compile(f"{_TERM}|{_END}")
#: The same for texts without kanji and katakana: their words are runs of hiragana.
_KANA_TERM = _TERM + "|[ぁ-ゖー]{2,}"
_KANA_TERMS, _KANA_TOKENS = re.compile(_KANA_TERM), re.compile(f"{_KANA_TERM}|{_END}")
_HEAVY = re.compile("[一-鿿ァ-ヺ]")
_INVISIBLE = re.compile("[­​-‏ -‮⁠-⁤﻿︀-️]")


def _clean(text: str) -> str:
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
    return text.replace("\r", "\n").strip(" \t\n　。!?").lower()


def sentences(text: str) -> list[str]:
    """Sentences of a text in lower case, without their end marks."""
    text = _clean(text)
    return re.split(_END, text) if text else []


def terms(text: str) -> list[str]:
    """Runs of one script of a text in lower case; hiragana only where there is neither kanji nor katakana."""
    text = text.lower()
    return (_TERMS if _HEAVY.search(text) else _KANA_TERMS).findall(text)


class _Slots(dict):
    """Slot of each term; -1 for the end of a sentence."""

    def __missing__(self, token: str) -> int:
        if len(self) > 400_000:
            self.clear()
        found = xxhash.xxh3_64_intdigest(token.encode()) >> (64 - TERM_BITS) if _KANA_TERMS.match(token) else -1
        self[token] = found
        return found


_slots = _Slots()


def slot(term: str) -> int:
    return _slots[term]


_BAGS = "row_id bigint, n_sentences int, terms array<int>, places array<int>"


def bags(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row_id, n_sentences, terms, places``: hashed terms of each text and the sentence each stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _BAGS.split(", ")]
        for batch in batches:
            tokens: list[int] = []
            sizes = [0]
            for text in batch.column(1).to_pylist():
                text = _clean(text) if text else ""
                if text:
                    tokens += map(_slots.__getitem__, (_TOKENS if _HEAVY.search(text) else _KANA_TOKENS).findall(text))
                    tokens.append(-1)
                sizes.append(len(tokens))
            flat, edges = np.array(tokens, np.int32), np.array(sizes)
            ends = np.append(0, np.cumsum(flat < 0))
            before = ends[edges]  # sentences before each text
            kept = flat >= 0
            offsets = np.append(0, np.cumsum(kept))[edges].astype(np.int32)
            places = (ends[:-1] - np.repeat(before[:-1], np.diff(edges)))[kept].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (flat[kept], places)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(before).astype(np.int32)), *lists], names)

    rows = docs.selectExpr(f"CAST({id_col} AS BIGINT) AS row_id", text_col).filter("row_id IS NOT NULL")
    return rows.mapInArrow(run, _BAGS)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, numbers of sentences, and of each term its document, slot and sentence."""
    lists, places = batch.column("terms"), batch.column("places")
    sizes = np.diff(lists.offsets.to_numpy())
    return (
        batch.column("row_id").to_numpy(zero_copy_only=False), batch.column("n_sentences").to_numpy(zero_copy_only=False),
        np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(), places.flatten().to_numpy(),
    )


def document_counts(table: DataFrame) -> np.ndarray:
    """Documents of each slot; at most 2**TERM_BITS numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TERM_BITS, np.int64)
        for batch in batches:
            _, _, doc, term, _ = _columns(batch)
            both = np.unique(doc.astype(np.int64) << TERM_BITS | term)
            counts += np.bincount(both & ((1 << TERM_BITS) - 1), minlength=1 << TERM_BITS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"])

    found = table.coalesce(coarse(table)).mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << TERM_BITS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


class TopicModel:
    """Term weights of the topics; the last topic is the common one."""

    def __init__(self, index: np.ndarray, counts: np.ndarray, subjects: list[str | None]):
        self.index = index  # of each slot, its column or -1
        self.weights = (counts / np.maximum(counts.sum(0), 1e-30)).astype(np.float32)  # columns x topics: p(term | topic)
        self.telling = counts.max(1, initial=0.0) >= PURITY * counts.sum(1)
        self.subjects = subjects  # of each topic

    @property
    def alpha(self) -> np.ndarray:
        alpha = np.full(self.weights.shape[1], ALPHA, np.float32)
        alpha[-1] = ALPHA_COMMON
        return alpha

    def infer(self, doc: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
        """Topic proportions of each term occurrence, given its document's others."""
        k = self.weights.shape[1]
        likely = self.weights[column]
        theta = np.full((n, k), 1.0 / k, np.float32)
        starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, int)
        alpha, share = self.alpha, likely
        for turn in range(INNER):
            share = np.take(theta, doc, axis=0)
            share *= likely
            share /= np.maximum(np.einsum("ij->i", share), 1e-30)[:, None]
            if turn < INNER - 1 and len(starts):
                theta[doc[starts]] = np.add.reduceat(share, starts, axis=0) + alpha
                theta /= np.einsum("ij->i", theta)[:, None]
        return share


def start_model(examples: list[tuple[str, str]], docs_with: np.ndarray, n_docs: int) -> TopicModel:
    """Topics of the example texts, over the slots frequent enough in the corpus.

    A term of the examples that three subjects or more use belongs to the
    common topic; every other slot may turn out to belong to any.
    """
    names = sorted({s for s, _ in examples})
    given = np.zeros(1 << TERM_BITS, bool)
    given[[slot(t) for _, body in examples for x in sentences(body) for t in terms(x)]] = True
    used = np.flatnonzero((docs_with >= LEAST_DOCS) | given & (docs_with > 0))
    index = np.full(1 << TERM_BITS, -1, np.int32)
    index[used] = np.arange(len(used))
    seen = np.zeros((len(used), len(names)))
    for subject, body in examples:
        for t in {t for s in sentences(body) for t in terms(s)}:
            if index[slot(t)] >= 0:
                seen[index[slot(t)], names.index(subject)] += 1
    spread = (seen > 0).sum(1)
    own = seen / np.maximum(seen.sum(1, keepdims=True), 1)
    frequency = docs_with[used] / max(n_docs, 1)
    weights = np.zeros((len(used), len(names) + 1))
    weights[:, :-1] = np.where((spread > 0)[:, None], np.where((spread <= 2)[:, None], own, 0.0), 1.0 / max(len(names), 1)) * frequency[:, None]
    weights[:, -1] = frequency * np.where(spread > 2, 1.0, 0.1)
    return TopicModel(index, weights + 1e-7, [*names, None])


def _expected(table: DataFrame, model: TopicModel) -> np.ndarray:
    """One round: expected counts of columns x topics over all documents.

    Each of as many tasks as the session has cores, twice over, sends its sums
    once, in blocks of BLOCK columns that meet block by block: what is shuffled
    grows with the cluster and not with the data.
    """
    shape = model.weights.shape
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                _, _, doc, term, _ = _columns(part)
                column = own.index[term]
                doc, column = doc[column >= 0], column[column >= 0]
                share = own.infer(doc, column, part.num_rows)
                for k in range(shape[1]):
                    total[:, k] += np.bincount(column, share[:, k], minlength=shape[0])
        blocks = [total[at : at + BLOCK].astype(np.float32).tobytes() for at in range(0, shape[0], BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array(blocks, pa.binary())], ["block", "n"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["n"])
        return pd.DataFrame({"block": group["block"].iloc[:1], "n": [total.astype(np.float32).tobytes()]})

    few = table.coalesce(coarse(table)).mapInArrow(run, "block int, n binary")
    found = few.groupBy("block").applyInPandas(add, "block int, n binary").collect()
    total = [np.frombuffer(r["n"], np.float32).astype(np.float64) for r in sorted(found, key=lambda r: r["block"])]
    return np.concatenate([np.zeros(0), *total]).reshape(-1, shape[1]) if total else np.zeros(shape)


def map_topics(model: TopicModel, examples: list[tuple[str, str]], top: int = 40) -> list[str | None]:
    """The subject of each topic but the common one: that of the examples which use most of its top terms' weight."""
    names = sorted({s for s, _ in examples})
    used = np.zeros((len(model.weights), len(names)))
    for subject, body in examples:
        for t in {t for s in sentences(body) for t in terms(s)}:
            if model.index[slot(t)] >= 0:
                used[model.index[slot(t)], names.index(subject)] += 1
    used = np.where(((used > 0).sum(1) <= 2)[:, None], used, 0.0)
    out: list[str | None] = []
    for k in range(model.weights.shape[1] - 1):
        best = np.argsort(-model.weights[:, k])[:top]
        votes = (model.weights[best, k][:, None] * (used[best] > 0)).sum(0)
        out.append(names[int(votes.argmax())] if len(names) and votes.max() > 0 else None)
    return [*out, None]


def fit(table: DataFrame, examples: list[tuple[str, str]]) -> TopicModel:
    """The topic model of all documents of a :func:`bags` table."""
    n_docs = table.count()
    model = start_model(examples, document_counts(table), n_docs)
    if not len(model.weights):
        return model
    for _ in range(ROUNDS):
        model = TopicModel(model.index, _expected(table, model) + ETA, model.subjects)
    model.subjects = map_topics(model, examples)
    return model


_SHARES = "row_id bigint, n_sentences int, subject string, share double"


def subject_shares(table: DataFrame, model: TopicModel) -> DataFrame:
    """``row_id, n_sentences, subject, share``: share of a document's sentences about a subject, where above 0."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = [x.split()[0] for x in _SHARES.split(", ")]
        labels = np.array([s or "" for s in own.subjects], object)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids, n_sentences, doc, term, place = _columns(part)
                column = own.index[term] if len(own.weights) else np.full(len(term), -1)
                kept = column >= 0
                doc, column, place = doc[kept], column[kept], place[kept]
                if not len(doc):
                    continue
                share = own.infer(doc, column, part.num_rows)[:, :-1] * own.telling[column, None]
                key = doc.astype(np.int64) << 32 | place
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                per_sentence = np.add.reduceat(share, starts, axis=0)
                best = per_sentence.argmax(1)
                about = per_sentence[np.arange(len(best)), best] >= LEAST_TERMS
                pair, count = np.unique(doc[starts][about].astype(np.int64) * 1000 + best[about], return_counts=True)
                d, k = pair // 1000, pair % 1000
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[d]), pa.array(n_sentences[d]), pa.array(labels[k].tolist(), pa.string()), pa.array(count / n_sentences[d])], names
                )

    found = table.mapInArrow(run, _SHARES)
    return found.filter("subject <> ''")


def assign_subjects(docs: DataFrame, examples: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, subject, share``: the subjects that a quarter or more of a document's sentences are about.

    None, one or several rows a document; null, empty and blank texts
    and rows with a null id have none, nor has any document of an empty corpus or without examples.
    Repeated rows are assigned alike.  ``examples`` (``subject, body``) is
    read on the driver: a list of short texts, not part of the corpus.
    """
    given = [(r["subject"], r["body"]) for r in examples.select("subject", "body").collect() if r["subject"] and r["body"]]
    if not given:
        return docs.limit(0).select(F.col(id_col).cast("bigint").alias(id_col), F.lit("").alias("subject"), F.lit(0.0).alias("share"))
    table = materialise(bags(docs, id_col, text_col), "bags")
    shares = subject_shares(table, fit(table, given))
    # Two topics may have come to mean one subject.
    shares = shares.groupBy("row_id", "subject").agg(F.sum("share").alias("share"))
    return shares.filter(F.col("share") >= LEAST_SENTENCES).select(F.col("row_id").alias(id_col), "subject", "share")
