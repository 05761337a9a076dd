"""Plain Python versions of scores, windows and quotas, one text at a time, with all parameters written out."""

import hashlib
import heapq
import math
import re
from collections import defaultdict

import pyarrow as pa

from beneflow.llm.words import BY_LETTER, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
# Tells a prefix from the same word on its own.
ODD = 0x9E3779B97F4A7C15


def word_hash(word: bytes) -> int:
    """The library's name for a word that is looked up alone, be it cut within a letter."""
    return int(words(pa.array([word], pa.binary()).view(pa.string()), BY_LETTER).hashes[0])


def toxicity_scores(model, texts):
    """Logistic of the bias and the weights of all distinct words and of their first 4 to 8 bytes."""
    weights = dict(zip(model.vocabulary.hashes.tolist(), model.weights.tolist(), strict=True))
    known: dict = {}

    def hash_of(word):
        if word not in known:
            known[word] = word_hash(word)
        return known[word]

    out = []
    for text in texts:
        found = set()
        for word in set(WORD.findall((text or "").translate(FOLD))):
            whole = word.encode()
            found |= {hash_of(whole)} | {(hash_of(whole[:n]) * ODD + n) % 2**64 for n in (4, 5, 6, 7, 8) if len(whole) > n}
        margin = model.bias + sum(weights.get(f, 0.0) for f in found)
        out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, margin)))))
    return out


def rule_scores(model, rows):
    """Logistic of the bias and the weights of the rules whose bounds all hold."""
    out = []
    for row in rows:
        margin = model.bias
        for rule, weight in model.weighted:
            if all(above < row[name] <= up_to for name, above, up_to in rule.bounds):
                margin += weight
        out.append(1 / (1 + math.exp(-margin)))
    return out


def text_statistics(text):
    text = text or ""
    w, lines = TOKEN.findall(text), [x for x in text.split("\n") if x]
    share = lambda part, whole: part / whole if whole else 0.0
    count = lambda signs: len(re.findall(signs, text))
    return {
        "chars": len(text), "words": len(w), "lines": len(lines), "word_length": share(sum(map(len, w)), len(w)),
        "longest_word": max(map(len, w), default=0), "short_words": share(sum(len(x) <= 2 for x in w), len(w)),
        "distinct_words": share(len(set(w)), len(w)), "distinct_lines": share(len(set(lines)), len(lines)),
        "line_length": share(len(text), len(lines)), "capitals": share(count("[A-Z]"), len(text)),
        "digits": share(count("[0-9]"), len(text)), "sentence_ends": share(count("[.!?]"), len(text)),
        "commas": share(count("[,;:]"), len(text)),
        "other_signs": share(count(r"[^A-Za-z0-9\x20\x09-\x0D.,;:!?\x80-\U0010FFFF]"), len(text)),
        "beyond_ascii": share(count(r"[^\x00-\x7F]"), len(text)),
    }


def benchmark_windows(items):
    """Windows of 13 words by their number of words; a shorter item is one."""
    windows = defaultdict(set)
    for text in items:
        w = WORD.findall((text or "").translate(FOLD))
        n = min(13, len(w))
        windows[n] |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    return {n: s for n, s in windows.items() if n}


def is_contaminated(text, windows):
    """At least one word in twenty inside an occurrence of a window."""
    w = WORD.findall((text or "").translate(FOLD))
    hit = {i + j for n, s in windows.items() for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in s for j in range(n)}
    return bool(hit) and 20 * len(hit) >= len(w)


def highest_quotients(votes, seats, most):
    """Seats one by one, ties to the first."""
    out = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0 and most[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def mixture(rows):
    """(doc_id, text) of the mix of rows (doc_id, source, text): weights 1, 2, 3, at most three times, blocks of 64 words,
    16 shards, buckets of 50,000 words, seed 17.
    """
    by_source = defaultdict(list)
    for doc_id, source, text in rows:
        by_source[source].append((doc_id, text, len(TOKEN.findall(text or ""))))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for *_, n in by_source[s]) for s in names]
    weight = [(1, 2, 3)[i % 3] for i in range(len(names))]
    aims, open_ones, left = [0.0] * len(names), {i for i, n in enumerate(sizes) if n}, sum(sizes)
    while open_ones:
        whole = sum(weight[i] for i in open_ones)
        above = [i for i in open_ones if left * weight[i] > 3 * sizes[i] * whole]
        for i in above or open_ones:
            aims[i] = float(3 * sizes[i]) if above else left * weight[i] / whole
        left -= sum(3 * sizes[i] for i in above)
        open_ones = open_ones - set(above) if above else set()
    out = []
    for source, seats in enumerate(highest_quotients(aims, sum(sizes), [3 * n for n in sizes])):
        own = by_source[names[source]]
        sub = max(1, -(-max(sizes[source], len(own)) // (16 * 50_000)))
        shards = [[] for _ in range(16)]
        for doc_id, text, n in own:
            digest = hashlib.md5((text or "").encode()).hexdigest()
            key = hashlib.md5(f"17:{'null' if doc_id is None else doc_id}:{digest}".encode()).hexdigest()
            bucket = int(key[:8], 16) % (sub * 16)
            shards[bucket // sub].append((bucket, key, doc_id, text, n))
        totals = [sum(d[-1] for d in docs) for docs in shards]
        for shard, quota in enumerate(highest_quotients([float(t) for t in totals], seats, [3 * t for t in totals])):
            total = totals[shard]
            if not total:
                continue
            times, rest = divmod(quota, total)
            seed = int(hashlib.md5(f"17:{source}:{shard}".encode()).hexdigest()[:8], 16)
            start = 64 * (seed % -(-total // 64))
            # The words once more, in a circle from the chosen block on.
            ranges = [(start, min(start + rest, total)), (0, max(0, start + rest - total))]
            at = 0
            for _, _, doc_id, text, n in sorted(shards[shard], key=lambda d: d[:3]):
                out += [(doc_id, text)] * (times if n else 0)
                spans = [m.span() for m in TOKEN.finditer(text or "")]
                for low, high in ranges:
                    first, end = max(0, low - at), min(n, high - at)
                    if first < end:
                        out.append((doc_id, text if (first, end) == (0, n) else text[spans[first][0] : spans[end - 1][1]]))
                at += n
    return out
