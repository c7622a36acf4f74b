"""Operator 5: toxicity by weak supervision.

Many weak voters look at a text: one for each lexicon term (a short public
list, and words and word stems that stand out in labelled toxic texts) and
some for patterns (shouting, masked words, insults in the second person, no
term at all). A generative label model, fitted by expectation-maximisation,
estimates how often each voter is right for either class and how far voters
repeat each other given the class; correlated voters share their weight. Its
posterior labels train a linear classifier over a wider vocabulary, which
scores every whole text in one pass with an Aho-Corasick automaton.

Both are fitted on all texts. One pass finds the features of every text
(terms and patterns, all binary) and adds up the texts of each distinct set of
features; the label model sums over the sets' votes, and the linear classifier
takes Newton steps whose loss, gradient and curvature are sums over the
sets, in integers, so any partitioning gives the same model. Labels outside the held-out
fold enter from up to ``labelled.SAMPLE_ROWS`` documents. Scoring covers every row in
place, without a shuffle. Labels, lang, source and doc_id never reach a score.

The model's size is bounded by parameters, whatever the corpus: at most
``VOTERS`` mined voters beside the public list, and ``VOCABULARY`` terms in all,
those that tell most by the likelihood ratio; a mined term occurs in ``MIN_DOCS``
labelled texts or more, near copies counted once.

Defined cases: a null text is empty and gets the classifier's base score;
repeated rows are scored alike; with no labels the public list alone votes;
no rows give no rows.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm import labelled
from tickerlake.llm.common import extended, give_back, mix64, small_batches, written

DRIVER_PATTERNS = 50_000  # distinct patterns that the driver sums itself, at most
DRIVER_ITEMS = 2_000_000  # and features in them
VOTERS = 300              # lexicon voters, at most
VOCABULARY = 1_500        # terms of the linear classifier, at most
STEMS = (4, 5, 6)         # lengths of word stems
MINING_ROUNDS = 4
MIN_DOCS = 3              # texts a mined term occurs in, at least
HELD_TERMS = 200_000      # counts that a mining task holds before it passes them on
BANDS = 8                 # keys of a text that tell its near copies

# Common English insults.
LEXICON = ["idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "scum", "trash", "pathetic",
           "worthless", "disgusting", "clown", "dumb", "dumbass", "imbecile", "retard", "bastard", "bitch",
           "asshole", "fuck", "fucking", "shit", "bullshit", "crap", "whore", "slut", "pig", "filth", "vermin"]

_ONE = 1 << 30            # fixed point of the models' sums
_CURVE = 1 << 20          # and of second derivatives: products stay exact in doubles up to 2**35 texts
_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_UPPER = bytes(range(65, 91))
_LETTER = bytes([*range(65, 91), *range(97, 123)])
_INSULT = re.compile(r"\byou(?:'re| are) (?:an? )?\w+", re.I)
_MASKED = re.compile(r"\b\w+\*+\w")
PATTERNS = ("shouts", "exclaims", "masked", "second_person", "no_term", "long_no_term")


def plain(text: str) -> str:
    """Lower-cased words between single or more blanks, one at either end."""
    return " " + text.lower().encode().translate(_KEEP).decode() + " "


def terms_of(words) -> set[str]:
    """Whole words as `` word `` and stems as `` stem``."""
    out = set()
    for w in words:
        out.add(f" {w} ")
        for n in STEMS:
            if len(w) >= n:
                out.add(f" {w[:n]}")
    return out


def patterns_of(text: str, raw: bytes, found: bool) -> list[float]:
    letters = len(raw) - len(raw.translate(None, _LETTER))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return [float(letters > 20 and upper > 0.5 * letters), float(raw.count(b"!!") >= 3),
            float(b"*" in raw and _MASKED.search(text) is not None),
            float((b"you" in raw or b"You" in raw or b"YOU" in raw) and _INSULT.search(text) is not None),
            float(not found), float(not found and len(raw) > 2000)]


# Pattern voters vote for this class when they fire, else abstain.
PATTERN_SAYS = (1, 1, 1, 1, 0, 0)


def mine_terms(sample: DataFrame, known: list[str], at_most: int) -> list[str]:
    """Terms that stand out in those toxic texts of ``sample`` (doc_id, y,
    text) that hold no ``known`` term: by the likelihood ratio of their document counts, beyond what the
    number of candidates would give by chance. Of a stem and longer terms
    with the same toxic texts, the longest stays."""
    def count(batches):
        machine = automaton_of(known)
        seen: dict[str, list[int]] = {"": [0, 0]}

        def counted():
            keys = list(seen)
            for at in range(0, len(keys), 50_000):
                part = keys[at:at + 50_000]
                yield pa.RecordBatch.from_pydict({"term": part, "clean": [seen[k][0] for k in part], "toxic": [seen[k][1] for k in part]})
            seen.clear()
            seen[""] = [0, 0]

        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                text, y = plain(text.as_py() or ""), 1 if y else 0
                if known and next(machine.iter(text), None) is not None:
                    continue
                seen[""][y] += 1
                for t in terms_of(set(text.split())):
                    seen.setdefault(t, [0, 0])[y] += 1
                if len(seen) > HELD_TERMS:          # counts add up after the shuffle
                    yield from counted()
        yield from counted()
        give_back()

    counts = written(sample.select("y", "text").mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
        .where((F.col("c") + F.col("t") >= MIN_DOCS) | (F.col("term") == "")), "terms")
    total = counts.where("term = ''").first()
    if total is None or not total["c"] or not total["t"]:
        return []
    candidates = counts.count()
    t, c = F.col("t"), F.col("c")
    both = t + c
    share = total["t"] / (total["t"] + total["c"])
    part = lambda x, expected: F.when(x > 0, x * F.ln(x / expected)).otherwise(0.0)
    g2 = 2 * (part(t, both * share) + part(c, both * (1 - share)))
    rows = (counts.where("term <> ''").withColumn("g2", F.round(g2, 6))
            .where((t / both >= 0.7) & (F.col("g2") >= 2 * (math.log(max(candidates, 2)) + 3)))
            .orderBy(F.desc("g2"), F.desc(F.length("term")), "term").limit(4 * at_most).collect())
    kept: list[str] = []
    for r in rows:
        term = r["term"]
        if not any(term.startswith(k) or k.startswith(term.rstrip()) for k in kept):
            kept.append(term)
    return kept[:at_most]


def band_keys(text: str | None) -> list[int]:
    """``BANDS`` keys of a text, two minima each of hashes of its five-word
    runs: near copies share some key, other texts hardly ever."""
    words = np.array([zlib.crc32(w.encode()) for w in (text or "").lower().split()], np.uint64)
    n = max(len(words) - 4, min(len(words), 1))
    runs = np.zeros(n, np.uint64)
    for k in range(min(5, len(words))):
        runs = mix64(runs ^ words[k:k + n])
    low = [mix64(runs + np.uint64(seed)).min() if n else np.uint64(0) for seed in range(1, 2 * BANDS + 1)]
    return mix64(np.array(low[::2], np.uint64) ^ mix64(np.array(low[1::2], np.uint64))).view(np.int64).tolist()


def without_copies(sample: DataFrame) -> DataFrame:
    """``sample`` (doc_id, y, text) with one of near copies that have the same
    label: a word that is in one much copied text is no sign of its class."""
    def run(batches):
        for batch in batches:
            keys = [band_keys(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "y", "keys"])

    schema = sample.select("doc_id", "y", F.array(F.lit(0).cast("long")).alias("keys")).schema
    keys = written(sample.select("doc_id", "y", "text").mapInArrow(run, schema)
                   .select("doc_id", (F.col("y") > 0).alias("y"), F.posexplode("keys").alias("band", "key")), "bands")
    first = keys.groupBy("y", "band", "key").agg(F.min("doc_id").alias("_first"))
    copies = keys.join(first, ["y", "band", "key"]).where("doc_id <> _first").select("doc_id").distinct()
    return written(sample.join(copies, "doc_id", "left_anti"), "distinct-sample")


def features(texts: list[str | None], automaton, size: int, lexicon: int):
    """Per text: the indexes of terms found, and the pattern values."""
    for text in texts:
        text = text or ""
        found = {i for _, i in automaton.iter(plain(text))} if size else set()
        yield sorted(found), patterns_of(text, text.encode(), any(i < lexicon for i in found))


def automaton_of(terms: list[str]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        machine.add_word(t, i)
    if terms:
        machine.make_automaton()
    return machine


def _logit(model: dict, rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Log odds of ``n`` texts from their votes (``rows``: whose)."""
    ratio = np.log(model["theta"][1] / model["theta"][0]) * model["weight"]
    prior = model["prior"]
    cast = np.stack([ratio[1] - ratio[0], ratio[2] - ratio[0]], axis=1).ravel()
    return math.log(prior / (1 - prior)) + ratio[0].sum() + (np.bincount(rows, cast[codes], n) if len(rows) else np.zeros(n))


def tally(rows: np.ndarray, codes: np.ndarray, gold: np.ndarray, count: np.ndarray, m: int, model: dict | None, known_only: bool) -> np.ndarray:
    """What a step of the label model sums over texts with the posterior q
    under ``model``: texts, q, q * q, then per vote texts and q. In fixed
    point, so any order and grouping of the texts gives the same sums."""
    n, known = len(gold), gold >= 0
    if model is None:
        post = np.full(n, 0.05)
        post[rows[codes % 2 == 1]] = 0.9
    else:
        post = 1 / (1 + np.exp(-np.clip(_logit(model, rows, codes, n), -30, 30)))
    q = np.where(known, np.where(gold == 1, 0.99, 0.01), post)
    use = np.where(known, count, 0) if known_only else count
    uq = use * np.rint(q * _ONE).astype(np.int64)
    out = np.zeros(3 + 4 * m, np.int64)
    out[:3] = use.sum(), uq.sum(), (use * np.rint(q * q * _ONE).astype(np.int64)).sum()
    np.add.at(out, 3 + codes, use[rows])
    np.add.at(out, 3 + 2 * m + codes, uq[rows])
    return out


def together(rows: np.ndarray, codes: np.ndarray, count: np.ndarray, m: int) -> np.ndarray:
    """Sums over texts of the products of two voters' votes (+1, -1, or 0)."""
    out = np.zeros((m, m))
    for at in range(0, len(count), 2_048):
        here = (rows >= at) & (rows < at + 2_048)
        value = np.zeros((min(2_048, len(count) - at), m))
        value[rows[here] - at, codes[here] // 2] = 2 * (codes[here] % 2) - 1
        out += value.T @ (value * count[at:at + 2_048, None])
    return out


def fit_votes(sums, products: np.ndarray, both: bool, m: int, steps: int = 30) -> dict:
    """Each voter's vote probabilities (abstains, clean, toxic) for either
    class, and its weight after sharing among voters that correlate given the
    class, by expectation-maximisation. ``sums(model, known_only)``: ``tally``
    over all texts; ``both``: labels of both classes are known."""
    model, weight = None, np.ones(m)
    for step in range(steps):
        s = sums(model, step == 0 and both)                                  # known labels start it
        n, ones = float(s[0]), s[1] / _ONE
        cast, toxic = s[3:3 + 2 * m].reshape(m, 2).T.astype(float), s[3 + 2 * m:].reshape(m, 2).T / _ONE
        size = (n - ones, ones)
        votes = [np.stack([y - v.sum(axis=0), v[0], v[1]]) for y, v in zip(size, (cast - toxic, toxic))]
        smooth = np.array([[0.6], [0.2], [0.2]])
        theta = np.stack([(v + smooth) / (y + 1.0) for y, v in zip(size, votes)])
        if step in (4, steps - 2):   # what voters share beyond the class
            mean = theta[:, 2] - theta[:, 1]
            value = [(v[2] - v[1]) / n for v in votes]
            square = s[2] / _ONE / n
            share = (((n - 2 * ones) / n + square, ones / n - square), (ones / n - square, square))
            cov = products / n + sum(share[a][b] * np.outer(mean[a], mean[b]) for a in (0, 1) for b in (0, 1))
            for a in (0, 1):
                cov -= np.outer(value[a], mean[a]) + np.outer(mean[a], value[a])
            centre = sum(value[a] - mean[a] * size[a] / n for a in (0, 1))
            cov -= np.outer(centre, centre)
            sd = np.sqrt(np.maximum(np.diag(cov), 0)) + 1e-9
            rho = cov / np.outer(sd, sd)
            np.fill_diagonal(rho, 0)
            weight = 1 / (1 + np.maximum(rho - 0.1, 0).sum(axis=1))
        model = {"theta": theta, "weight": weight, "prior": float(np.clip(ones / n, 1e-3, 0.999))}
    return model


def posterior(model: dict, rows: np.ndarray, codes: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """The probability that each text is toxic, by its votes and label."""
    logit = np.clip(_logit(model, rows, codes, len(gold)), -30, 30)
    return 1 / (1 + np.exp(-(logit + np.where(gold >= 0, np.where(gold == 1, 4.0, -4.0), 0.0))))


def label_model(votes: np.ndarray, gold: np.ndarray, steps: int = 30) -> dict:
    """``fit_votes`` and ``posterior`` of votes (texts x voters, 1 toxic, 0
    clean, -1 abstains). ``gold``: 1 or 0 where a label is known, else -1."""
    rows, voter = np.nonzero(votes >= 0)
    codes = 2 * voter + votes[rows, voter]
    m, count = votes.shape[1], np.ones(len(gold), np.int64)
    model = fit_votes(lambda now, known: tally(rows, codes, gold, count, m, now, known), together(rows, codes, count, m),
                      bool((gold == 0).any() and (gold == 1).any()), m, steps)
    return {"posterior": posterior(model, rows, codes, gold), **model}


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) of a column of lists."""
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def few(patterns: DataFrame, lists: str) -> bool:
    """Whether the driver sums the patterns itself."""
    n = patterns.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(lists)).alias("items")).first()
    return n["rows"] <= DRIVER_PATTERNS and (n["items"] or 0) <= DRIVER_ITEMS


def _local(patterns: DataFrame, lists: str) -> tuple[np.ndarray, ...]:
    t = patterns.toArrow().combine_chunks()
    if not t.num_rows:
        return (np.zeros(0, np.int64),) * 4
    return *_flat(t.column(lists).combine_chunks()), *(t.column(c).to_numpy().astype(np.int64) for c in ("y", "texts"))


def fit_patterns(patterns: DataFrame, m: int) -> dict:
    """The label model of texts given as (y, votes, texts): each distinct
    pattern of votes with the number of its texts. Few are summed on the
    driver, many in Spark; the sums are the same numbers."""
    known = {r["y"] for r in patterns.select("y").distinct().collect()}
    if few(patterns, "votes"):
        rows, codes, gold, count = _local(patterns, "votes")
        return fit_votes(lambda now, known: tally(rows, codes, gold, count, m, now, known), together(rows, codes, count, m), known >= {0, 1}, m)

    def over(kernel, schema):
        def run(batches):
            for b in batches:
                if b.num_rows:
                    rows, codes = _flat(b.column("votes"))
                    yield kernel(rows, codes, *(b.column(c).to_numpy().astype(np.int64) for c in ("y", "texts")))

        return patterns.mapInArrow(run, schema)

    def pairs(rows, codes, _gold, count):
        c = together(rows, codes, count, m)
        i, j = np.nonzero(c)
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(c[i, j].astype(np.int64))], names=["i", "j", "c"])

    products = np.zeros((m, m))
    for r in over(pairs, "i long, j long, c long").groupBy("i", "j").agg(F.sum("c").alias("c")).collect():   # m * m at most
        products[r["i"], r["j"]] = r["c"]

    def sums(now, known_only):
        def kernel(rows, codes, gold, count):
            s = tally(rows, codes, gold, count, m, now, known_only)
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(s))), pa.array(s)], names=["at", "s"])

        out = np.zeros(3 + 4 * m, np.int64)
        for r in over(kernel, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect():
            out[r["at"]] = r["s"]
        return out

    return fit_votes(sums, products, known >= {0, 1}, m)


def codes_of(size: int, voters: int) -> np.ndarray:
    """The vote of each feature: terms, then patterns; -1: a term that does not vote."""
    terms = [2 * j + 1 if j < voters else -1 for j in range(size)]
    return np.array(terms + [2 * (voters + j) + says for j, says in enumerate(PATTERN_SAYS)], np.int64)


def targets(label_model: dict, codes: np.ndarray, rows: np.ndarray, cols: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """The posterior labels of patterns of features."""
    voting = codes[cols] >= 0
    return posterior(label_model, rows[voting], codes[cols[voting]], gold)


def newton_sums(rows: np.ndarray, cols: np.ndarray, target: np.ndarray, count: np.ndarray, w: np.ndarray):
    """Loss, gradient and second derivatives of the logistic loss at ``w``
    (the last weight is the base), as integer sums over the texts."""
    n, size = len(target), len(w)
    z = np.clip(w[-1] + (np.bincount(rows, w[cols], n) if len(rows) else np.zeros(n)), -30, 30)
    p = 1 / (1 + np.exp(-z))
    loss = int((count * np.rint((np.logaddexp(0, z) - target * z) * _CURVE).astype(np.int64)).sum())
    err = count * np.rint((p - target) * _ONE).astype(np.int64)
    grad = np.zeros(size, np.int64)
    np.add.at(grad, cols, err[rows])
    grad[-1] = err.sum()
    bend = (count * np.rint(p * (1 - p) * _CURVE).astype(np.int64)).astype(float)
    curve = np.zeros((size, size), np.int64)
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    for at in range(0, n, 512):
        a, b = np.searchsorted(rows, [at, at + 512])
        used, place = np.unique(cols[a:b], return_inverse=True)
        x = np.zeros((min(512, n - at), len(used) + 1))
        x[rows[a:b] - at, place] = 1
        x[:, -1] = 1
        used = np.append(used, size - 1)
        curve[np.ix_(used, used)] += (x.T @ (x * bend[at:at + 512, None])).astype(np.int64)
    return loss, grad, curve


def newton(sums, size: int, texts: int, l2: float = 1e-4, steps: int = 30) -> np.ndarray:
    """Logistic regression from ``sums(w)``: (loss, gradient, curvature) as
    integers over ``texts``; steps that make the loss larger are halved."""
    w, step, best, slope, bend = np.zeros(size), np.zeros(size), math.inf, None, None
    decay = np.full(size, l2)
    decay[-1] = 1e-9
    for _ in range(steps):
        loss, grad, curve = sums(w - step)
        at = loss / _CURVE / texts + float((decay * (w - step) ** 2).sum()) / 2
        if at <= best + 1e-9:
            small = float(np.abs(step).max()) < 1e-3 and best < math.inf
            w, best = w - step, min(at, best)
            if small:
                break
            slope = grad / _ONE / texts + decay * w
            bend = curve / _CURVE / texts + np.diag(decay)
            step = np.linalg.solve(bend, slope)
        else:
            step = step / 2
    return w


def linear_fit(patterns: DataFrame, label_model: dict, codes: np.ndarray) -> np.ndarray:
    """The weight of each feature, and the base: logistic regression on the
    posterior labels of all texts, given as (y, found, texts)."""
    size = len(codes) + 1
    texts = patterns.agg(F.sum("texts")).first()[0]

    if few(patterns, "found"):
        rows, cols, gold, count = _local(patterns, "found")
        target = targets(label_model, codes, rows, cols, gold)

        return newton(lambda w: newton_sums(rows, cols, target, count, w), size, texts)

    def spread(w):
        """Sums by (i, j): loss at (-1, -1), gradient at (i, -1); at most a
        square of the model's size comes back."""
        def run(batches):
            total = [0, np.zeros(size, np.int64), np.zeros((size, size), np.int64)]     # of the whole task
            for b in batches:
                if b.num_rows:
                    rows, cols = _flat(b.column("found"))
                    gold, count = (b.column(c).to_numpy().astype(np.int64) for c in ("y", "texts"))
                    for k, part in enumerate(newton_sums(rows, cols, targets(label_model, codes, rows, cols, gold), count, w)):
                        total[k] += part
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(size), -1)), pa.array(np.full(size + 1, -1)),
                                              pa.array(np.append(total[1], total[0]))], names=["i", "j", "v"])
            for k in range(0, size, 64):
                i, j = np.nonzero(total[2][k:k + 64])
                yield pa.RecordBatch.from_arrays([pa.array(i + k), pa.array(j), pa.array(total[2][i + k, j])], names=["i", "j", "v"])

        got = patterns.mapInArrow(run, "i long, j long, v long").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
        i, j, v = (got.column(c).to_numpy() for c in ("i", "j", "v"))
        grad, one = np.zeros(size, np.int64), (j < 0) & (i >= 0)
        grad[i[one]] = v[one]
        curve = np.zeros((size, size), np.int64)
        curve[i[j >= 0], j[j >= 0]] = v[j >= 0]
        return int(v[i < 0].sum()), grad, curve

    return newton(spread, size, texts)


def feature_patterns(docs: DataFrame, sample: DataFrame, terms: list[str], voters: int) -> DataFrame:
    """(y, found, texts) over all of ``docs``: the distinct sets of features
    (terms, then patterns) with their texts; a labelled text of ``sample`` with its label,
    any other with y = -1."""
    size = len(terms)

    def find(batches):
        machine = automaton_of(terms)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            found = [f + [size + j for j, x in enumerate(p) if x] for f, p in features(texts, machine, size, voters)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["y", "found"])

    known = sample.select("doc_id", F.xxhash64("text").alias("_text"))       # bounded, so it may be broadcast
    others = (docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
              .join(F.broadcast(known), ["doc_id", "_text"], "left_anti").select(F.lit(-1).alias("y"), "text"))
    both = sample.select((F.col("y") > 0).cast("int").alias("y"), "text").union(others)
    return written(both.mapInArrow(find, "y int, found array<int>").groupBy("y", "found").agg(F.count(F.lit(1)).alias("texts")), "features")


def vote_patterns(patterns: DataFrame, codes: np.ndarray) -> DataFrame:
    """(y, votes, texts): the patterns of features by the votes in them."""
    code = F.array(*[F.lit(int(c)) for c in codes])
    votes = F.filter(F.transform("found", lambda j: F.element_at(code, j + 1)), lambda c: c >= 0)
    return written(patterns.groupBy("y", votes.alias("votes")).agg(F.sum("texts").alias("texts")), "votes")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model as plain arrays, some hundred kB at most."""
    with small_batches(docs.sparkSession):
        return _fit(docs, labels)


def _fit(docs: DataFrame, labels: DataFrame) -> dict:
    sample = written(labelled.labelled_sample(docs, labels, "toxic"), "toxic-sample")
    public = [f" {w} " for w in LEXICON]
    terms, distinct = list(public), without_copies(sample)
    for _ in range(MINING_ROUNDS):       # then what marks the toxic texts not yet explained
        mined = mine_terms(distinct, terms, VOCABULARY)
        terms = list(dict.fromkeys(terms + mined))[:VOCABULARY]
        if not mined:
            break
    voters, size = min(len(terms), len(public) + VOTERS), len(terms)
    patterns = feature_patterns(docs, sample, terms, voters)
    if patterns.limit(1).count() == 0:
        return {"terms": terms, "voters": voters, "w": np.zeros(size), "d": np.zeros(len(PATTERNS)), "b": -3.0}
    codes = codes_of(size, voters)
    model = fit_patterns(vote_patterns(patterns, codes), voters + len(PATTERNS))
    w = linear_fit(patterns, model, codes)
    return {"terms": terms, "voters": voters, "w": w[:size], "d": w[size:-1], "b": float(w[-1]), "label_model": model}


def score(docs: DataFrame, model: dict, name: str = "_score") -> DataFrame:
    """``docs`` with a column ``name``: 0 to 1, in place, no shuffle."""
    names, schema = docs.columns, extended(docs.schema, **{name: "double"})
    terms, voters, w, d, b = (model[k] for k in ("terms", "voters", "w", "d", "b"))

    def run(batches):
        machine = automaton_of(terms)
        for batch in batches:
            out = np.empty(batch.num_rows)
            texts = batch.column(names.index("text"))
            for i, (found, pats) in enumerate(features((t.as_py() for t in texts), machine, len(terms), voters)):
                z = b + float(w[found].sum()) + float(np.dot(d, pats))
                out[i] = 1 / (1 + math.exp(-min(max(z, -30), 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*names, name])

    return docs.mapInArrow(run, schema)
