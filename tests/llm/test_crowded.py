"""Work under shingles of many documents alike."""

import random

from larder.llm import common as C
from larder.llm import jaccard_join as J


def near_copies(n: int, words: int, edits: int, seed: int) -> dict[int, str]:
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = {}
    for i in range(n):
        own = list(base)
        for at in draw.sample(range(words), edits):
            own[at] = f"x{i}y{at}"
        out[i] = " ".join(own)
    return out


def brute_components(texts: dict[int, str]) -> dict[int, int]:
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in texts}


def test_many_near_copies_do_not_ask_every_group_that_fell_out(spark, monkeypatch):
    """One large component and what first groups left over: pairs grow with the leftovers, not with copies
    times leftovers."""
    texts = near_copies(300, 150, 2, 5)
    kept, keep = {}, C.Scratch.keep

    def counted(self, df, name):
        out = keep(self, df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(C.Scratch, "keep", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = J.similar_components(docs, J.JoinParams(orders=1, crowded_pairs=100)).select("doc_id", "component_id").collect()
    assert {r[0]: r[1] for r in found} == brute_components(texts)
    assert kept["pairs"] < 3 * len(texts), kept
