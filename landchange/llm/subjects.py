"""Subject areas of documents, by averaged word and subword embeddings with independent logistic outputs.

The unit is the sentence: its words' vectors (each the mean of the embeddings of the word and its character n-grams, hashed)
are averaged, and every subject has a logistic output of its own. Labels are per document, so sentences are first taught their
document's labels in equal parts, later the label that the model itself finds in the sentence, or none, so boilerplate and
passing remarks lose their part. Partitions hold shards of the labelled sentences; each round every shard gives the gradient of
its sentences at the shared weights, and the sum of all shards' gradients moves the weights by one step, whose moments are kept
from round to round. So the result doesn't depend on how the sentences are spread.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from landchange.session import stage

#: Labelled documents that are learnt from at most (by hash, where there are more), and how many make a shard.
MAX_LABELLED, SHARD_DOCUMENTS = 50_000, 2_500
BUCKETS, WIDTH, ROUNDS, SOFT_ROUNDS, RATE = 1 << 15, 24, 40, 15, 0.15
#: Share of a document's sentences from which a subject is its own; probability from which a sentence is about a subject.
LEAST_SHARE, LEAST_P = 0.2, 0.5


def sentences(text: str | None) -> list[str]:
    """Sentences of a text, by line and closing mark; tags and headings are taken out, pieces without a letter are none."""
    if not text:
        return []
    plain = html.unescape(re.sub(r"<[^<>]*>", "\n", text)) if "<" in text or "&" in text else text
    out = []
    for line in plain.splitlines():
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        out += [s for s in re.split(r"(?<=[.!?])[\"')\]]*\s+", line) if any(c.isalpha() for c in s)]
    return out


TOKEN = re.compile(r"\w+").findall


def plain_word(token: str) -> str:
    if token.isalpha():
        return token
    if any(c.isalpha() for c in token):
        token = token.replace("1", "l").replace("0", "o")
    return re.sub(r"\d+", "0", token)


def words(sentence: str) -> list[str]:
    """Lower-case words; numbers become 0, and digits that stand for letters inside a word (1 for l, 0 for o) are undone."""
    return [plain_word(w) for w in TOKEN(sentence.lower())]


def word_features(word: str) -> list[int]:
    """Hashed features of a word, however long: itself and its character 3- to 5-grams with word ends."""
    edged = f"<{word}>"
    grams = {edged} | {edged[i : i + n] for n in (3, 4, 5) for i in range(len(edged) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in sorted(grams)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Values and begins of lists none of which is empty."""
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter((v for x in lists for v in x), np.int64, int(sizes.sum())), np.cumsum(sizes) - sizes


def make_shard(texts: list[str], labels: list[list[int]], outputs: int) -> dict | None:
    """Arrays of a shard's sentences, words and features, and the documents' labels by sentence."""
    index: dict[str, int] = {}
    sentence_words, targets, allowed = [], [], []
    for text, own in zip(texts, labels):
        for s in sentences(text):
            ids = [index.setdefault(w, len(index)) for w in words(s)]
            if ids:
                sentence_words.append(ids)
                row = np.zeros(outputs, np.float32)
                row[own] = 1.0
                allowed.append(row)
    if not sentence_words:
        return None
    feats, feat_at = _flat([word_features(w) for w in index])
    word, word_at = _flat(sentence_words)
    return {"feats": feats.astype(np.int32), "feat_at": feat_at, "word": word.astype(np.int32), "word_at": word_at, "allowed": np.array(allowed)}


def _mean_rows(rows: np.ndarray, at: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.append(at, total)).astype(np.float32)[:, None]
    return np.add.reduceat(rows, at, axis=0) / sizes, sizes


class _Scatter:
    """Sums rows by index, with the order prepared once."""

    def __init__(self, index: np.ndarray):
        self.order = np.argsort(index, kind="stable")
        ordered = index[self.order]
        self.at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        self.keys = ordered[self.at]

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return np.add.reduceat(rows[self.order], self.at, axis=0)


def start_weights(outputs: int, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {"e": rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32), "w": rng.normal(0, 0.1, (WIDTH, outputs)).astype(np.float32), "b": np.full(outputs, -2.0, np.float32)}


class Shard:
    """Sentences of a shard, ready for any number of rounds."""

    def __init__(self, arrays: dict):
        self.feats, self.word, self.allowed = arrays["feats"], arrays["word"], arrays["allowed"]
        self.feat_at, self.word_at = arrays["feat_at"], arrays["word_at"]
        self.by_feat, self.by_word = _Scatter(self.feats), _Scatter(self.word)
        self.word_sizes = np.diff(np.append(self.feat_at, len(self.feats)))
        self.sent_sizes = np.diff(np.append(self.word_at, len(self.word)))

    def gradient(self, weights: dict, soft: bool) -> dict[str, np.ndarray]:
        """The sum of the sentences' gradients at the weights, of the embeddings only the rows the shard uses. soft: taught the
        document's labels in equal parts; else the one of them, if any, that the model finds in the sentence."""
        e, w, allowed = weights["e"], weights["w"], self.allowed
        word_vec, _ = _mean_rows(e[self.feats], self.feat_at, len(self.feats))
        mean, _ = _mean_rows(word_vec[self.word], self.word_at, len(self.word))
        p = 1 / (1 + np.exp(-np.clip(mean @ w + weights["b"], -30, 30)))
        if soft:
            target = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
        else:
            among = np.where(allowed > 0, p, -1.0)
            target, sure = np.zeros_like(allowed), among.max(1) > 0.35
            target[sure, among.argmax(1)[sure]] = 1.0
        out = (p - target).astype(np.float32)
        per_word = np.zeros((len(self.word_sizes), e.shape[1]), np.float32)
        per_word[self.by_word.keys] = self.by_word(np.repeat(out @ w.T / self.sent_sizes[:, None].astype(np.float32), self.sent_sizes, axis=0))
        by_feat = self.by_feat(np.repeat(per_word / self.word_sizes[:, None].astype(np.float32), self.word_sizes, axis=0))
        return {"rows": self.by_feat.keys, "e": by_feat, "w": mean.T @ out, "b": out.sum(0), "n": len(allowed)}


class Adam:
    """Steps down summed gradients, with moments kept from step to step."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights, self.turn = weights, 0
        self.moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for k, g in gradients.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.weights[k] = self.weights[k] - (RATE * (m / (1 - 0.9**self.turn)) / (np.sqrt(v / (1 - 0.99**self.turn)) + 1e-8)).astype(np.float32)


def labelled_documents(documents: DataFrame, labels: DataFrame, subjects: list[str]) -> DataFrame:
    """(doc_id, text, own ARRAY<INT>) of labelled documents: the subjects that anyone gave them.
    Unknown subjects, null ids and repeated labels don't count. At most about MAX_LABELLED documents, chosen by hash."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("subject").isin(subjects))
    place = F.array_position(F.array(*map(F.lit, subjects)), F.col("subject")).cast("int") - 1
    own = known.groupBy("doc_id").agg(F.sort_array(F.collect_set(place)).alias("own"))
    many = own.count()
    if many > MAX_LABELLED:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * MAX_LABELLED / many))
    return documents.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(own), "doc_id").dropDuplicates(["doc_id"])


def train(labelled: DataFrame, outputs: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights learnt from labelled documents (doc_id, text, own); the start weights where there are none."""
    spark = labelled.sparkSession

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if held:
            rows = pd.concat(held).sort_values("doc_id")
            shard = make_shard(rows["text"].tolist(), [list(x) for x in rows["own"]], outputs)
            if shard:
                yield pd.DataFrame({"shard": [pickle.dumps(shard)]})

    labelled = stage(labelled, "labelled")
    count = -(-labelled.count() // SHARD_DOCUMENTS) or 1  # by rows; at most MAX_LABELLED / SHARD_DOCUMENTS or so
    # held by the executors from round to round; what is lost with one is read again from the written table
    shards = stage(labelled.repartition(count, F.xxhash64("doc_id")).mapInPandas(pack, "shard BINARY"), "shards").repartition(count).persist()
    learner = Adam(start_weights(outputs, seed))
    for turn in range(ROUNDS):
        shared, soft = spark.sparkContext.broadcast(learner.weights), turn < SOFT_ROUNDS

        def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard in batch["shard"]:
                    yield pd.DataFrame({"gradient": [pickle.dumps(Shard(pickle.loads(shard)).gradient(shared.value, soft))]})

        # one gradient a shard, none larger than the weights
        parts = [pickle.loads(r["gradient"]) for r in shards.mapInPandas(step, "gradient BINARY").collect()]
        total = sum(g["n"] for g in parts)
        if not total:
            break
        whole = {k: np.zeros_like(v) for k, v in learner.weights.items()}
        for g in sorted(parts, key=lambda g: (g["n"], float(g["b"].sum()))):  # in one order, so that sums round alike
            whole["e"][g["rows"]] += g["e"] / total
            whole["w"] += g["w"] / total
            whole["b"] += g["b"] / total
        learner.step(whole)
        shared.destroy()  # the round is over, no task asks for it again
    shards.unpersist()
    return learner.weights


def subject_shares(documents: DataFrame, weights: dict[str, np.ndarray], subjects: list[str]) -> DataFrame:
    """(doc_id, subject, about, sentences): of every document, the subjects that some sentence is about, and how many of its
    sentences are. Null and blank texts give no rows; equal rows give equal rows."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    # embeddings and outputs meet only in their product: one number per feature and subject
    shared = spark.sparkContext.broadcast((weights["e"] @ weights["w"], weights["b"]))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, bias = shared.value
        index: dict[str, int] = {}
        known = np.zeros((1024, table.shape[1]), np.float32)
        cut = float(np.log(LEAST_P / (1 - LEAST_P)))
        for batch in batches:
            if len(index) > 1_000_000:
                index.clear()
            ids, at, owner, counts = [], [], [], []
            for row, text in enumerate(batch["text"]):
                n = 0
                for s in sentences(text):
                    own = TOKEN(s.lower())
                    if not own:
                        continue
                    n += 1
                    at.append(len(ids))
                    owner.append(row)
                    for w in own:
                        k = index.get(w)
                        if k is None:  # tokens are kept as they stand, so that each is looked into once
                            k = index[w] = len(index)
                            if k >= len(known):
                                known = np.vstack([known, np.zeros_like(known)])
                            known[k] = table[word_features(plain_word(w))].mean(0)
                        ids.append(k)
                counts.append(n)
            if not at:
                continue
            mean, _ = _mean_rows(known[np.array(ids)], np.array(at), len(ids))
            about = np.zeros((len(batch), table.shape[1]), np.int64)
            np.add.at(about, np.array(owner), (mean + bias > cut).astype(np.int64))
            r, c = np.nonzero(about)
            if not len(r):
                continue
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[r], "subject": np.array(subjects, object)[c], "about": about[r, c], "sentences": np.array(counts)[r]})

    return documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInPandas(score, f"doc_id {kind}, subject STRING, about BIGINT, sentences BIGINT")


def classify(documents: DataFrame, labels: DataFrame, areas: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, subject, about, sentences) of subjects that at least LEAST_SHARE of a document's sentences are about.

    areas: the subjects, at most some thousands. Without labels nothing is learnt and nothing found.
    """
    subjects = sorted(r["subject"] for r in areas.where("subject IS NOT NULL").select("subject").distinct().collect())
    if not subjects:
        return subject_shares(documents.limit(0), start_weights(1), ["-"])
    weights = train(labelled_documents(documents, labels, subjects), len(subjects), seed)
    return subject_shares(documents, weights, subjects).where(F.col("about") >= F.lit(LEAST_SHARE) * F.col("sentences") - 1e-9)
