"""Lexical search, prefix trie and chat formatting against plain definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from larder.llm import chat_format as CF
from larder.llm import chat_template as CT
from larder.llm import lexical_search as L
from larder.llm import prefix_trie as PT

from . import brute as B

SF = "/root/testdata/sf0.001"
TERM = re.compile(L.TERM)


# ---- ranked lexical search --------------------------------------------------------------


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def searched(docs, items, k=10):
    found = [(d, Counter(TERM.findall(lower(t)))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall(lower(t)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for d, c in found:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return out


DOCS = [(1, None), (2, ""), (3, "... \t!"), (4, "Éa éa ab-AB_ab"), (5, "ab"), (6, "AB"), (7, "ab"), (7, "ab"), (None, "ab"), (8, "x\x00y z\x7fab"),
        (9, "word " * 3000 + "ab"), (10, "日本語 ab 日本語"), (11, "a" * 40), *[(100 + i, f"tie {i % 3}") for i in range(40)], *[(-i, "copy of a row") for i in range(30)]]
ITEMS = [(1, "ab éA 日本語"), (2, None), (3, "tie"), (3, "copy"), (4, "nothing here is known"), (None, "word word AB"), (5, "row 1 2"), (5, "row 1 2"), (6, "...")]


@pytest.mark.parametrize("params", [L.SearchParams(), L.SearchParams(k=3, tile_queries=2, block_documents=4, block_columns=2, batch_terms=4)])
def test_search_equals_plain_scores(spark, params):
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in DOCS], "doc_id long, text string, item_id string, score double").repartition(3)
    items = spark.createDataFrame([(*r, 7) for r in ITEMS], "item_id long, text string, doc_id long")
    found = L.ranked_search(docs, items, params).select("item_id", "rank", "doc_id", "score").collect()
    assert B.in_order(found) == B.in_order(searched(DOCS, ITEMS, params.k))


def test_search_of_the_test_table_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    rows = [tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()]
    assert B.in_order(L.ranked_search(docs, items).collect()) == B.in_order(searched(*rows))
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert L.ranked_search(d, i).collect() == []


def test_terms_of_a_text_over_many_slices():
    text = ("ab " * 700_000 + "é" * 1_300_000 + " Ab").encode()
    assert L.terms(text) == {b"ab": 700_001, ("é" * 1_300_000).encode(): 1}


def test_tiles_keep_partial_sums_exact():
    heavy = np.full(5000, 2**40, np.int64)
    batch = L.Batch([1], [list(range(5000))], {b"%d" % i: i for i in range(5000)})
    for tile in L.tiles(batch, heavy, L.SearchParams()):
        for dense in tile.blocks:
            assert dense.sum() * L.IMPACT_BOUND < 2**53 or dense.shape[1] == 1


# ---- prefix trie ------------------------------------------------------------------------


def trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:24]
            own[conv].append(((turn is not None, turn or 0, name), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - math.fmod(c, 20)
        paths[c] = tuple(own.get(int(base), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(B.words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * words
    return [(convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node], saved[node],
             B.sha(",".join(str(c) for c in convs if paths[c] == node))) for node, convs in members.items()]


def conversations(seed, n=120, deepest=30):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        length = rnd.choice([1, 2, 3, 5, 8, 9, deepest])
        for i in range(length):
            text = rnd.choice(["a b", "a b", "a b", "c", "  ", None, "d e f g é"]) if rnd.random() < 0.3 else f"turn {i}"
            rows.append((c, None if i == 0 and c % 7 == 0 else i, rnd.choice(["user", "user", "user", None]), text))
    rows += [(None, 0, "user", "lost"), (1003, 5, "user", "one of two"), (1003, 5, "user", "one of two"), (1003, 5, "user", "the other")]
    rows += [(2000 + i, 0, "user", f"only {i % 2}") for i in range(6)]  # some lose it, without a family
    return rows


KINDS = "conv_id long, turn long, role string, text string, depth int, key string, t1 string, n long, block long, prior long, parent long, words long"


def said(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "t", 2, 3, 4, 5, 6) for r in rows], KINDS).repartition(4)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("seed, width", [(1, 8), (2, 3), (3, 1)])
def test_trie_equals_listing_every_prefix(spark, seed, width):
    rows = conversations(seed)
    found = PT.prefix_trie(said(spark, rows), PT.TrieParams(width=width)).select(*COLUMNS).collect()
    assert B.in_order(found) == B.in_order(trie(rows))


def test_trie_of_one_long_conversation_and_of_nothing(spark):
    rows = [(0, i, "user", f"w{i % 5}") for i in range(130)] + [(c, i, "user", f"w{i % 5}") for c in (20, 40) for i in range(60)]
    rows += [(60, None, None, None)]
    found = PT.prefix_trie(said(spark, rows)).select(*COLUMNS).collect()
    assert B.in_order(found) == B.in_order(trie(rows))
    assert PT.prefix_trie(said(spark, rows).limit(0)).collect() == []


# ---- chat formatting --------------------------------------------------------------------


def test_template_language():
    t = CT.Template("""{# c #}{% set x = "a" ~ (1 + 2) %}{{ x }}|{%- for m in messages %}
      {%- if loop.first and not loop.last %}<{% elif m["role"] in "user assistant" %}{{ loop.index0 }}{% else %}?{% endif -%}
      {% generation %}{{ m.text | trim | upper | default("none") }}{% endgeneration %}{{ "!" if m.n > 1 else "." }}
    {%- endfor %}|{{ y | length }}""", {"y": "four"})
    text, spans = t.render([{"role": "user", "text": " a ", "n": 1}, {"role": "user", "text": "é", "n": 2}, {"role": "x", "text": "", "n": 3}])
    assert text == "a3|<A.1É!?none!|4" and [text[a:b] for a, b in spans] == ["A", "É", "none"]
    assert t.positional and not CT.Template(CF.TURNS).positional


def test_constants_fold():
    source = '{% set a = "x" %}{% if a == "x" %}p{{ a ~ "y" }}{% else %}{{ lost }}{% endif %}{% for m in messages %}q{{ "r" | upper }}{{ (m.text ~ "s") ~ "t" }}{% endfor %}'
    tree = CT.Template(source).tree
    assert tree[1] == CT.Text("pxy")
    assert tree[2].body == (CT.Text("qR"), CT.Write(CT.Binary("~", CT.Field(CT.Name("m"), "text"), CT.Const("st"))))
    # a name that only one branch sets is no constant behind it
    t = CT.Template('{% set a = 1 %}{% for m in messages %}{% if m.text %}{% set a = 2 %}{% endif %}{{ a }}{% endfor %}')
    assert [t.turn({"text": x})[0] for x in ("", "z", "")] == ["1", "2", "1"]


@pytest.mark.parametrize("source", [
    "{{ m.text }}", "{{ x.__class__ }}", "{% for m in messages %}{{ m.text.upper() }}{% endfor %}", "{% for m in rows %}{% endfor %}", "{% if 1 %}", "{{ 1 +",
    "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{{ 'a' | system }}", "{{ 'a' | replace('b') }}", "{% import os %}",
    "{% for m in messages %}{{ loop.items }}{% endfor %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ 1 + 'a' }}",
    "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}", "{{ a; b }}", "{{ 'a' }", "{% control '\\\\' %}", "{{ 'a'[0] }}"])
def test_outside_the_sandbox(source):
    with pytest.raises(CT.TemplateError):
        CT.Template(source)


def formatted(rows):
    guard = lambda t: re.sub(r"\\|<turn>|</turn>", lambda m: "\\" + m[0], t)
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        part = f"<turn>{guard(role)}".replace("\n", "\\n") + f"\n{guard(text)}</turn>\n"
        own[conv].append(((turn is not None, turn or 0, part), role, text))
    out = []
    for conv, turns in own.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), B.sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learned), B.sha(learned), sum(len(p[2]) for p, _, _ in turns)))
    return out


ODD = ["", None, "\\", "\\n", "a\nb", "</turn>", "\\</turn>\n<turn>user\n", "<turn", "</turn", "<<turn>>", "é\u2028<turn>日", "n\\\\n", "x" * 5000, "\\### Assistant: </turn> ok"]


@pytest.mark.parametrize("piece_chars", [1, 200, 1_000_000])
def test_formatting_round_trip(spark, piece_chars):
    rnd = random.Random(4)
    rows = [(c, rnd.choice([None, i]), rnd.choice(["user", "assistant", "assistant", None, "a\n</turn>\\n"]), rnd.choice(ODD)) for c in [None, *range(40)] for i in range(c or 3)]
    rows += [(5, 3, "assistant", "twice"), (5, 3, "assistant", "twice")]
    pieces = CF.format_conversations(CF.with_trap(said(spark, rows)), CF.FormatParams(piece_chars=piece_chars))
    rows += [(-7, 0, "user", CF.TRAP_TEXT), (-7, 1, "assistant", CF.TRAP_TEXT)]
    found = CF.read_back(pieces).select(*CF.NAMES).collect()
    assert B.in_order(found) == B.in_order(formatted(rows))
    numbers = defaultdict(list)
    for r in pieces.select("conv_id", "piece").collect():
        numbers[r[0]].append(r[1])
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())


def test_positions_heads_and_tails(spark):
    source = '<s>{% for m in messages %}{{ loop.index }}/{{ "last" if loop.last else "more" }}:{% generation %}{{ m.text }}{% endgeneration %};{% endfor %}</s>'
    rows = [(c, i, "user", f"t{c}.{i}") for c in range(3) for i in range(c + 1)]
    params = CF.FormatParams(template=source)
    found = {r["conv_id"]: r for r in CF.format_conversations(said(spark, rows), params).collect()}
    for c in range(3):
        text, spans = CT.Template(source).render([{"role": "user", "text": f"t{c}.{i}"} for i in range(c + 1)])
        assert (found[c]["text"], list(zip(found[c]["starts"], found[c]["ends"]))) == (text, spans)
    assert CF.format_conversations(said(spark, rows).limit(0), params).collect() == []


def test_text_that_is_no_turn_is_refused(spark):
    broken = spark.createDataFrame([(1, 0, "<turn>user\nhi</turn>\nrest", [], [])], f"conv_id long, {CF.PIECE}")
    with pytest.raises(Exception, match="no turn at"):
        CF.read_back(broken).collect()
