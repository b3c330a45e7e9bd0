"""Plain, slow versions of operators, from their definitions: no code of theirs but for the hashed random numbers."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from caseloom.llm import mixing

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingle_counts(text, width=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else Counter([tuple(w)])


def weighted_pairs(texts, least=0.0):
    """{(i, j): weighted Jaccard similarity} of all pairs of texts that share a shingle, i < j; TF-IDF over exactly counted documents."""
    counts = [shingle_counts(t) for t in texts]
    df = Counter(s for c in counts for s in c)
    n = len(texts)
    weight = [{s: (1 + math.log(tf)) * (1 + math.log((1 + n) / (1 + df[s]))) for s, tf in c.items()} for c in counts]
    total = [sum(w.values()) for w in weight]
    have, out = defaultdict(list), {}
    for j, w in enumerate(weight):
        low = defaultdict(float)
        for s, x in w.items():
            for i, y in have[s]:
                low[i] += min(x, y)
            have[s].append((j, x))
        for i, both in low.items():
            if (sim := both / (total[i] + total[j] - both)) >= least:
                out[i, j] = sim
    return out


def components(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def water(sizes, weights=(5, 2, 1)):
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def random_numbers(spark, docs, seed=8):
    """Rows of ``docs`` with their size and uniform number, and the uniform numbers of strata."""
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")), r["u"]) for r in docs.select("doc_id", "source", "text", mixing.uniform(F.lit(seed), "doc_id", "text").alias("u")).collect()]
    strata = spark.createDataFrame(sorted({(s,) for _, s, _, _ in rows}, key=str), "source string").withColumn("stratum", F.explode(F.sequence(F.lit(0), F.lit(40))))
    return rows, {(r["source"], r["stratum"]): r["r"] for r in strata.withColumn("r", mixing.uniform(F.lit(seed), "source", "stratum")).collect()}


def expected_copies(sizes, target, power=0.25, most=2.0):
    """Expected copies of documents of these sizes (all above 0), so that their words add up to the target."""
    m = [2 ** (math.floor(math.log2(s) * 4 + 1e-9) * power / 4) for s in sizes]
    if target >= most * sum(sizes) - 1e-6:
        return [most] * len(sizes)
    low, high = 0.0, most / min(m)
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(most, mid * x) * s for x, s in zip(m, sizes)) < target else (low, mid)
    return [min(most, high * x) for x in m]


def mix(rows, strata, weights=(5, 2, 1)):
    """Copies of each row (doc_id, source, size, u), in their order."""
    sizes = defaultdict(int)
    for _, s, size, _ in rows:
        sizes[s] += size
    goal, out = water(sizes, weights), [0] * len(rows)
    for source in sizes:
        own = [k for k, r in enumerate(rows) if r[1] == source and r[2] > 0]
        if not own:
            continue
        e = dict(zip(own, expected_copies([rows[k][2] for k in own], goal[source])))
        pi = {k: e[k] - math.floor(e[k] + 1e-9) for k in own}
        pi = {k: x for k, x in pi.items() if x > 1e-9}
        for k in own:
            out[k] = math.floor(e[k] + 1e-9)
        y = {k: (q := rows[k][3] / (1 - rows[k][3]) * (1 - pi[k]) / pi[k]) / (1 + q) for k in pi}
        groups, carry, extra = defaultdict(list), 0.0, set()
        for k in pi:
            groups[math.floor(math.log2(rows[k][2]) * 4 + 1e-9) // 4].append(k)
        for stratum in sorted(groups, reverse=True):
            members = groups[stratum]
            words_, number = sum(pi[k] * rows[k][2] for k in members), sum(pi[k] for k in members)
            scale = 1 + carry / sum(pi[k] * rows[k][2] for s in groups if s <= stratum for k in groups[s])
            take = int(max(0, min(len(members), math.floor(number * scale + strata[source, stratum]))))
            carry += words_ - take * words_ / number
            extra |= set(sorted(members, key=lambda k: y[k])[:take])
        for k in extra:
            out[k] += 1
        gap = goal[source] - sum(out[k] * rows[k][2] for k in own)
        off = {k: abs(gap + rows[k][2]) if k in extra else abs(gap - rows[k][2]) for k in pi}
        near = [k for k in pi if off[k] < abs(gap)]
        if near:
            last = min(near, key=lambda k: (off[k], y[k]))
            out[last] += -1 if last in extra else 1
    return out
