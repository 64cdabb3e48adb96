"""Context-tree weighting over bytes.

A byte is eight binary decisions, most significant bit first. For each of the
255 decision nodes there is a context tree over the last ``DEPTH`` bytes; each of
its nodes holds a Krichevsky-Trofimov estimate of the bits seen there, and the
weighted probability of a node is the even mix of its own estimate and the
product over its children:

    P_w(s) = 1/2 P_kt(s) + 1/2 prod_c P_w(c s),   P_w = P_kt at full depth.

Both need only bit counts, so the tree is trained from counts of
(``DEPTH`` + 1)-byte strings. The predictive probability along a context path
mixes the estimates of all depths with the posterior weight
``P_kt / (2 P_w)`` that each node stops there. Scores use the tree frozen after
training.

Counting and look-ups are distributed alike: texts are dealt into blocks; a
block names each of its distinct strings (and words, for the unigram base) once
to the shard of the string's last two context bytes (of the word), which sums
the counts, holds the whole subtree below those two bytes, and answers with
probabilities. Only the two top levels, at most 256 x 255 nodes, pass the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLOCK_BYTES, ascii_lower, bound_batches, discard, free_finished, stage, text_bytes, total_bytes, with_block
from ledgerline.llm.packs import pack, shard_of, split_by, unpack, unpack_all

DEPTH = 5
#: Never a byte of UTF-8: stands before the text and ends it.
PAD = 0xFF
#: Positions handled at once, and strings that a shard is expected to get.
CHUNK = 1 << 18
COUNT_CHUNK = 1 << 19
SHARD_KEYS = 400_000
#: Bounds of the two top levels: (context byte, decision node).
TOP = 256 * 256

WORDS, STRINGS = 0, 1
LN2 = float(np.log(2.0))


def _codes(text: bytes) -> np.ndarray:
    """For each byte and the end mark: it and the ``DEPTH`` bytes before it, as one integer (oldest byte highest)."""
    padded = np.frombuffer(bytes([PAD] * DEPTH) + text + bytes([PAD]), np.uint8)
    code = np.zeros(len(text) + 1, np.uint64)
    for i in range(DEPTH + 1):
        code <<= np.uint64(8)
        code |= padded[i : i + len(code)]
    return code


#: log Gamma(n + 1/2) and log Gamma(n + 1) of small counts; beyond, Stirling's series is exact to double precision.
_SMALL = 1 << 14
_LG_HALF = np.log(np.pi) / 2 + np.r_[0.0, np.cumsum(np.log(np.arange(_SMALL - 1) + 0.5))]
_LG_ONE = np.r_[0.0, np.cumsum(np.log(np.arange(1, _SMALL)))]


def _lgamma(n: np.ndarray, table: np.ndarray, offset: float) -> np.ndarray:
    """log Gamma(n + offset) of whole counts."""
    out = table[np.minimum(n, _SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(n >= _SMALL)
    if len(large):
        x = n[large] + offset
        out[large] = (x - 0.5) * np.log(x) - x + 0.918938533204672742 + (1 / 12 - 1 / (360 * x * x)) / x
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of ``n0`` zeros and ``n1`` ones."""
    return (
        _lgamma(n0, _LG_HALF, 0.5) + _lgamma(n1, _LG_HALF, 0.5) - _lgamma(n0 + n1, _LG_ONE, 1.0) - np.log(np.pi)
    )


def _mix(log_est: np.ndarray, log_children: np.ndarray) -> np.ndarray:
    return np.logaddexp(log_est, log_children) - LN2


class Subtree:
    """All contexts that end in some two bytes, at depths 2..DEPTH, for the strings of one shard.

    The decision nodes of one depth and level (how many bits of the byte are
    known) are held together: their keys are the context's bytes followed by
    those bits, so strings sorted by context and byte have them in order.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """``codes`` are distinct; only those with a positive count have been seen."""
        seen = counts > 0
        codes, counts = codes[seen].astype(np.int64), counts[seen].astype(np.float64)
        self.keys: dict[tuple[int, int], np.ndarray] = {}
        self.one: dict[tuple[int, int], np.ndarray] = {}
        self.stop: dict[tuple[int, int], np.ndarray] = {}
        log_w: dict[int, np.ndarray] = {}
        tops = []
        for depth in range(DEPTH, 1, -1):
            strings = codes & ((1 << (8 * (depth + 1))) - 1)
            order = np.argsort(strings, kind="stable")
            strings, weight = strings[order], counts[order]
            for level in range(8):
                prefix = strings >> (8 - level)
                at = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]][: len(prefix)])
                keys = prefix[at]
                total = np.add.reduceat(weight, at) if len(at) else np.empty(0)
                ones = np.add.reduceat(weight * ((strings >> (7 - level)) & 1), at) if len(at) else np.empty(0)
                est = log_kt(total - ones, ones)
                if depth == DEPTH:
                    log_w[level] = est
                else:  # a child's key without its oldest byte is its parent's
                    parent = np.searchsorted(keys, self.keys[depth + 1, level] & ((1 << (8 * depth + level)) - 1))
                    log_w[level] = _mix(est, np.bincount(parent, weights=log_w[level], minlength=len(keys)))
                self.keys[depth, level] = keys
                self.one[depth, level] = (ones + 0.5) / (total + 1.0)
                self.stop[depth, level] = np.exp(est - log_w[level] - LN2) if depth < DEPTH else np.ones(len(keys))
                if depth == 2:
                    node = (1 << level) | (keys & ((1 << level) - 1))
                    tops.append((((keys >> level) & 255) << 8 | node, total - ones, ones, log_w[level]))
        self.tops = [np.concatenate(c) for c in zip(*tops, strict=True)]

    def top(self) -> pd.DataFrame:
        """Counts and log P_w of the depth-2 nodes, summed by (last byte, decision node)."""
        at = self.tops[0]
        sums = [np.bincount(at, weights=c, minlength=TOP) for c in self.tops[1:]]
        some = np.flatnonzero(np.bincount(at, minlength=TOP))
        return pd.DataFrame({"at": some, "n0": sums[0][some], "n1": sums[1][some], "log_w": sums[2][some]})

    def log10(self, codes: np.ndarray, one: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """log10 of the predicted probability of each string's last byte. ``one``: see ``top_levels``."""
        codes = codes.astype(np.int64)
        add, scale = one
        out = np.zeros(len(codes))
        for level in range(8):
            bit = (codes >> (7 - level)) & 1
            p = np.full(len(codes), 0.5)  # below an unseen context every bit is even
            for depth in range(DEPTH, 1, -1):
                keys = self.keys[depth, level]
                if not len(keys):
                    continue
                key = (codes & ((1 << (8 * (depth + 1))) - 1)) >> (8 - level)
                i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                odds, stop = self.one[depth, level][i], self.stop[depth, level][i]
                p = np.where(keys[i] == key, stop * np.where(bit == 1, odds, 1 - odds) + (1 - stop) * p, p)
            at = (codes & 0xFF00) | (1 << level) | ((codes & 255) >> (8 - level))
            out += np.log10(add[at, bit] + scale[at] * p)
        return out


def top_levels(top: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``(add, scale)``: at (last byte, node), a deeper probability p becomes add[bit] + scale * p.

    ``top`` has the sums of ``Subtree.top`` over all shards: depth 1; depth 0 is their sum.
    """
    at = top["at"].to_numpy(np.int64)
    n = np.zeros((TOP, 2))
    n[at] = top[["n0", "n1"]].to_numpy()
    children = np.zeros(TOP)
    children[at] = top["log_w"].to_numpy()
    est = log_kt(n[:, 0], n[:, 1])
    log_w = _mix(est, children)
    root_n = n.reshape(256, 256, 2).sum(0)
    root_est = log_kt(root_n[:, 0], root_n[:, 1])
    root_w = _mix(root_est, log_w.reshape(256, 256).sum(0))
    stop1, stop0 = np.exp(est - log_w - LN2), np.tile(np.exp(root_est - root_w - LN2), 256)
    kt1 = (n + 0.5) / (n.sum(1, keepdims=True) + 1)
    kt0 = np.tile((root_n + 0.5) / (root_n.sum(1, keepdims=True) + 1), (256, 1))
    add = stop0[:, None] * kt0 + ((1 - stop0) * stop1)[:, None] * kt1
    return add, (1 - stop0) * (1 - stop1)


def _tokens(text: bytes) -> list[bytes]:
    return text.split()


def _chunks(texts: list[bytes], most: int = CHUNK):
    """Codes of whole texts, joined up to about ``most`` positions (a longer text is cut into chunks)."""
    held, size = [], 0
    for i, text in enumerate(texts):
        code = _codes(text)
        for a in range(0, len(code), most):
            part = code[a : a + most]
            held.append((i, part))
            size += len(part)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _count_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for held in _chunks(texts, COUNT_CHUNK):
        code = np.concatenate([part for _, part in held])
        code.sort()
        at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        k, c = code[at], np.diff(np.r_[at, len(code)])
        if len(keys):
            at = np.searchsorted(keys, k)
            old = keys[np.minimum(at, len(keys) - 1)] == k
            counts[at[old]] += c[old]
            k, c = np.insert(keys, at[~old], k[~old]), np.insert(counts, at[~old], c[~old])
        keys, counts = k, c
    return keys, counts


def _ask(shards: int):
    """Block -> per shard its distinct words and strings, with their counts in the block's training texts."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = int(rows["block"].iloc[0])
        held = rows["held_out"].to_numpy()
        texts = [ascii_lower(text_bytes(t)) for t in rows.pop("text")]
        train = [t for t, h in zip(texts, held, strict=True) if not h]
        rest = [t for t, h in zip(texts, held, strict=True) if h]
        del texts
        out = [(block, s, STRINGS, *packed) for s, *packed in _strings_asked(train, rest, shards)]
        out += [(block, s, WORDS, *packed) for s, *packed in _words_asked(train, rest, shards)]
        return pd.DataFrame(out, columns=["block", "shard", "kind", "keys", "counts"])

    return run


def _words_asked(train: list[bytes], rest: list[bytes], shards: int):
    """Per shard its distinct words, and how often they are in ``train``."""
    seen: Counter[bytes] = Counter()
    for t in train:
        seen.update(_tokens(t))
    for t in rest:
        for w in set(_tokens(t)):
            seen.setdefault(w, 0)
    words = list(seen)
    count = np.fromiter(seen.values(), np.int64, len(words))
    shard = shard_of(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), shards)
    for s, i in split_by(shard, shards):
        yield s, b" ".join([words[j] for j in i]), pack(count[i])


def _strings_asked(train: list[bytes], rest: list[bytes], shards: int):
    """Per shard its distinct strings, and how often they are in ``train``."""
    keys, counts = _count_codes(train)
    other, _ = _count_codes(rest)
    new = other[~np.isin(other, keys, assume_unique=True)]
    keys, counts = np.concatenate([keys, new]), np.concatenate([counts, np.zeros(len(new), np.int64)])
    for s, i in split_by(shard_of((keys >> np.uint64(8)) & np.uint64(0xFFFF), shards), shards):
        yield s, pack(keys[i]), pack(counts[i])


def _sum_words(rows: pd.DataFrame) -> tuple[dict[bytes, int], list[list[bytes]]]:
    total: dict[bytes, int] = {}
    asked = []
    for keys, counts in zip(rows["keys"], rows["counts"], strict=True):
        words = keys.split(b" ") if keys else []
        for w, n in zip(words, unpack(counts, np.int64).tolist(), strict=True):
            total[w] = total.get(w, 0) + n
        asked.append(words)
    return total, asked


def _sum_codes(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, index = np.unique(unpack_all(rows["keys"], np.uint64), return_inverse=True)
    return keys, np.bincount(index, weights=unpack_all(rows["counts"], np.int64), minlength=len(keys)), index


def _measure(rows: pd.DataFrame) -> pd.DataFrame:
    """Shard -> its part of the two top levels; for words, of the vocabulary (at -1: words seen, tokens)."""
    if rows["kind"].iloc[0] == WORDS:
        total, _ = _sum_words(rows)
        seen = [n for n in total.values() if n]
        return pd.DataFrame({"at": [-1], "n0": [float(len(seen))], "n1": [float(sum(seen))], "log_w": [0.0]})
    keys, counts, _ = _sum_codes(rows)
    return Subtree(keys, counts).top()


def _answer(one):
    """Shard -> to each block, the training count of its words and log10 p of its strings."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["kind"].iloc[0] == WORDS:
            total, asked = _sum_words(rows)
            values = [pack(np.array([total[w] for w in words], np.int64)) for words in asked]
        else:
            keys, counts, index = _sum_codes(rows)
            score = Subtree(keys, counts).log10(keys, one.value)[index]
            ends = np.cumsum([len(k) // 8 for k in rows["keys"]])
            values = [pack(part) for part in np.split(score, ends[:-1])]
        return pd.DataFrame({"block": rows["block"], "kind": rows["kind"], "keys": rows["keys"], "values": values})

    return run


class _Table:
    """Values by 64-bit key: slots by multiplicative hashing, what collides goes to the next level."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        while len(keys):
            bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
            mix = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x51ED270B * len(self.levels))
            slot = (keys * mix) >> np.uint64(64 - bits)
            held = np.zeros(1 << bits, np.uint64)
            value = np.zeros(1 << bits)
            used = np.zeros(1 << bits, bool)
            held[slot], value[slot], used[slot] = keys, values, True
            lost = held[slot] != keys
            # Whatever was written last stays, with its own value.
            value[slot[~lost]] = values[~lost]
            self.levels.append((mix, np.uint64(64 - bits), held, value, used))
            keys, values = keys[lost], values[lost]

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan)
        live = np.arange(len(keys))
        for mix, shift, held, value, used in self.levels:
            want = keys[live]
            slot = (want * mix) >> shift
            hit = (held[slot] == want) & used[slot]
            out[live[hit]] = value[slot[hit]]
            live = live[~hit]
            if not len(live):
                break
        return out


def _score(total_tokens: int, vocabulary: int, train_docs: int):
    """Block and its answers -> one row per document."""
    scale = np.log10(total_tokens + (vocabulary + 1))

    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words, values = [], []
        mine = answers[answers["kind"] == WORDS]
        for keys, counts in zip(mine["keys"], mine["values"], strict=True):
            words += keys.split(b" ") if keys else []
            values.append(unpack(counts, np.int64))
        count = np.concatenate(values) if values else np.empty(0, np.int64)
        log_p = dict(zip(words, (np.log10(count + 1.0) - scale).tolist(), strict=True))
        unseen = {w for w, n in zip(words, count.tolist(), strict=True) if n == 0}
        mine = answers[answers["kind"] == STRINGS]
        table = _Table(unpack_all(mine["keys"], np.uint64), unpack_all(mine["values"], np.float64))
        del mine, answers, values
        texts = [ascii_lower(text_bytes(t)) for t in rows.pop("text")]
        score = np.zeros(len(texts))
        for held in _chunks(texts):
            got = table.get(np.concatenate([part for _, part in held]))
            begin = np.cumsum([0] + [len(part) for _, part in held[:-1]])
            np.add.at(score, [i for i, _ in held], np.add.reduceat(got, begin))
        end = float(np.log10(train_docs + 1.0) - scale)
        n_tokens, n_known, base = [], [], []
        for text in texts:
            tokens = _tokens(text)
            n_tokens.append(len(tokens) + 1)
            n_known.append(len(tokens) - sum(map(unseen.__contains__, tokens)) + (train_docs > 0))
            base.append(sum(map(log_p.__getitem__, tokens)) + end)
        n_bytes = np.array([len(t) for t in texts], np.int64)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"], "held_out": rows["held_out"], "n_tokens": n_tokens, "n_known": n_known,
                "train_tokens": total_tokens, "base_score": base, "score": score, "n_bytes": n_bytes,
                "bits_per_byte": -score * np.log2(10.0) / (n_bytes + 1),
            }
        )

    return run


def _held_out(folds: int, fold: int):
    @F.pandas_udf("boolean")
    def mark(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: x is not None and zlib.crc32(x.encode()) % folds == fold).astype(bool)

    return mark


def ctw_scores(
    docs: DataFrame, folds: int = 7, held_out_fold: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``.

    Texts are scored whole, A-Z lower-cased; null counts as empty. The model
    learns from the documents whose CRC-32 of the id's decimal text, modulo
    ``folds``, is not ``held_out_fold``, and scores all of them. ``score`` is the
    log10 probability of the text's bytes followed by an end mark under the
    frozen tree, ``bits_per_byte`` the code length per coded byte (the end mark
    included). ``base_score`` is the add-one unigram of ASCII-space separated words and
    one end per document; ``n_known`` counts tokens seen in training,
    ``train_tokens`` is their number there. A null id is never held out.
    Repeated rows are trained on and scored one by one; other columns are
    ignored. With no training document all words are unknown and every bit is
    even. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    n_bytes = total_bytes(rows, "text")
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    rows = with_block(rows, "doc_id", blocks).withColumn(
        "held_out", _held_out(folds, held_out_fold)(F.col("doc_id").cast("string"))
    )
    # A block of 8 MB names a few hundred thousand distinct words and strings.
    shards = max(1, -(-blocks * 400_000 // SHARD_KEYS))
    asked = stage(
        rows.repartition(blocks, "block").groupBy("block").applyInPandas(
            _ask(shards), "block int, shard int, kind int, keys binary, counts binary"
        ),
        "ctw-asked",
    )
    # One task for each group, or few: what a task sorts and a worker holds does not grow with the input.
    dealt = asked.repartition(2 * shards, "kind", "shard")
    parts = dealt.groupBy("kind", "shard").applyInPandas(_measure, "at long, n0 double, n1 double, log_w double")
    top = parts.groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "log_w"))).toPandas()
    free_finished(spark)
    train_docs = rows.where(~F.col("held_out")).count()
    vocabulary, tokens = top.loc[top["at"] == -1, ["n0", "n1"]].sum().astype(int).tolist()
    one = spark.sparkContext.broadcast(top_levels(top[top["at"] >= 0]))  # 256 x 255 nodes at most
    answers = stage(
        dealt.groupBy("kind", "shard").applyInPandas(_answer(one), "block int, kind int, keys binary, values binary"),
        "ctw-answers",
    )
    discard(asked)
    asking, answered = (df.repartition(blocks, "block").groupBy("block") for df in (rows, answers))
    return asking.cogroup(answered).applyInPandas(
        _score(tokens + train_docs, vocabulary + (train_docs > 0), train_docs),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, n_bytes long, bits_per_byte double",
    )
