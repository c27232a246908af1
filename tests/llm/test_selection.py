"""Packing, mixing, nearest neighbours, page text, shared helpers and the pipeline."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import common as C
from larder.llm import html_extract as H
from larder.llm import mixing as M
from larder.llm import nearest as N
from larder.llm import packing as K

from . import brute as B

SF = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = str(tokenizers.path("word_bpe_49k.json"))


# ------------------------------------------------------------------ packing


def check_places(rows, capacity=2048):
    rows = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    ends = Counter()
    for r in rows:
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert not ends or max(ends.values()) <= capacity
    return len(ends), -(-sum(r["length"] for r in rows) // capacity)


def test_pieces_and_places_of_whole_texts(spark):
    from tokenizers import Tokenizer

    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [(-1, None), (-2, ""), (None, "<|endoftext|> ab., 'LL é.,"), (-3, "word, " * 9000), (-3, "word, " * 9000)]
    docs = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, length int").repartition(3)
    rows = K.best_fit_packing(docs, TOKENIZER).collect()
    tokenizer, expected = Tokenizer.from_file(TOKENIZER), []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start:start + 2048]
            expected.append((doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert B.in_order(r[:5] for r in rows) == B.in_order(expected)
    used, least = check_places(rows)
    assert used <= least + 1
    assert K.best_fit_packing(docs.limit(0), TOKENIZER).count() == 0


def test_words_are_tokenized_as_in_their_text():
    rng = np.random.default_rng(3)
    from tokenizers import Tokenizer

    tokenizer, vocabulary = Tokenizer.from_file(TOKENIZER), K.Vocabulary(TOKENIZER)
    letters = [*"abAZ09.,'!<|>éÉßΣσİ€́  中，٣", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", " ", "\n", "\t"]
    for _ in range(500):
        text = "".join(rng.choice(letters, 30))
        words = text.encode().split()
        assert np.frombuffer(vocabulary.tokens([words])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("scale", [1, 40, 5000])
def test_configurations_place_everything_near_the_bound(scale):
    rng = np.random.default_rng(2)
    found = Counter(np.minimum(rng.lognormal(5.5, 1.2, 3000).astype(int) + 1, 2048).tolist())
    histogram = {n: c * scale for n, c in found.items()}
    used = K.patterns(histogram, K.PackingParams(rounds=150))
    placed = Counter()
    for pattern, many in used:
        assert sum(n * c for n, c in pattern) <= 2048
        for n, c in pattern:
            placed[n] += c * many
    assert placed == histogram
    least = -(-sum(n * c for n, c in histogram.items()) // 2048)
    assert sum(m for _, m in used) <= least * 1.002 + 1


def test_price_is_the_best_knapsack():
    lengths, value = np.array([3, 4, 7]), np.array([0.3, 0.45, 0.8])
    best = max(((a * 0.3 + b * 0.45 + c * 0.8), (a, b, c)) for a in range(9) for b in range(9) for c in range(9) if 3 * a + 4 * b + 7 * c <= 20)
    assert K.price(lengths, value, 20) @ value == pytest.approx(best[0])


# ------------------------------------------------------------------ mixing


def test_mix_equals_its_sql_with_odd_rows(spark, tmp_path):
    rows = [(i, "w " * (i % 13), "en de fr es".split()[i % 4], f"src{i * i % 7}") for i in range(400)]
    rows += [(1, None, None, None), (2, "", "en", "odd"), (None, "a b", "xx", "src1"), (3, "w " * 5000, "es", "src2"), (3, "w " * 5, "es", "src2")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(path)
    for params in (M.MixParams(), M.MixParams(budget=700), M.MixParams(budget=10**9, max_epochs=3), M.MixParams(weights={"lang": {"en": 9}}, seed=3)):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        expected = con.execute(M.sql(params)).fetchall()
        found = M.mix(spark.read.parquet(path).withColumn("passes", F.lit(1)), params).select("doc_id", *params.levels, "n_tokens", "copies").collect()
        assert B.in_order(found) == B.in_order((*e[:4], int(e[4]), int(e[5])) for e in expected)
    assert M.mix(spark.read.parquet(path).limit(0)).count() == 0


def test_budgets_follow_weights_and_siblings_take_shortages_first(spark):
    leaves = spark.createDataFrame([("web", "en", "a", 1000), ("web", "de", "b", 10), ("books", "en", "c", 1000)],
                                   "domain string, lang string, source string, tokens long")
    params = M.MixParams(weights={"domain": {"web": 1, "books": 1}, "lang": {}}, budget=1000, max_epochs=1)
    given = {(r["domain"], r["lang"]): r["given"] for r in M.leaf_budgets(leaves, params).collect()}
    assert given == {("web", "en"): 490, ("web", "de"): 10, ("books", "en"): 500}


def test_selected_rows_are_whole_rows(spark):
    docs = spark.createDataFrame([(i % 30, f"a b c {i}", "en", f"src{i % 3}", "k") for i in range(60)],
                                 "doc_id long, text string, lang string, source string, copies string")
    taken = M.select_documents(docs, M.MixParams(budget=100))
    assert taken.columns == docs.columns
    assert 80 <= taken.count() * 4 <= 100
    assert taken.exceptAll(docs.union(docs)).count() == 0


# ------------------------------------------------------------------ nearest


def brute_nearest(rows, k=5):
    rows = list(dict.fromkeys(rows))
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = Counter(len(v) for _, v in ok).most_common(1)[0][0]
    ok = [(i, np.array(v, float)) for i, v in ok if len(v) == size]
    out = {}
    for q, (i, v) in enumerate(ok):
        if i % 50 == 0:
            near = [(-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 12), j) for r, (j, w) in enumerate(ok) if r != q]
            out[i] = [j for _, j in sorted(near)[:k]]
    return out


def test_nearest_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, tuple(map(float, np.float32(rng.normal(size=16))))) for i in range(600)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [rows[0], rows[7]]
    rows += [(2000, None), (2050, ()), (2051, (0.0,) * 16), (2052, (float("nan"),) * 16), (2053, (None,) + (1.0,) * 15), (None, (1.0,) * 16), (2100, (1.0,) * 5)]
    frame = spark.createDataFrame([(i, list(v) if v is not None else None, 0.0) for i, v in rows], "vec_id long, embedding array<float>, score double").repartition(3)
    found = N.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    expected = brute_nearest(rows)
    assert got.keys() == expected.keys()
    assert sum(len(set(got[q]) & set(expected[q])) for q in got) >= 0.9 * sum(map(len, expected.values()))
    assert got[50] == [1000, 1001, 1002, 1003, 1004] and got[1000] == [50, 1001, 1002, 1003, 1004]
    assert N.nearest(frame.limit(0), F.lit(True)).count() == 0
    few = N.nearest(frame.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]


def test_ties_at_the_border_of_a_chunk_go_to_the_smaller_ids():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    v = rng.normal(size=16)
    for many in (40, 300):
        ids = rng.permutation(many)
        rows = [(v * 2.0 ** int(i % 40)).tolist() for i in ids]
        left = pa.table({"gid": pa.array(ids + 1), "embedding": pa.array(rows, pa.list_(pa.float64()))})
        right = pa.table({"query": pa.array([7]), "asked": pa.array([(v + 0.01 * rng.normal(size=16)).tolist()], pa.list_(pa.float64()))})
        assert N._compare(16, 6)((), left, right)["gid"].to_pylist() == [1, 2, 3, 4, 5, 6]


def test_hilbert_keys_walk_through_neighbours():
    side = np.arange(16)
    cells = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = N.hilbert_keys(cells, 4)
    assert sorted(keys.tolist()) == list(range(16**3))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# ------------------------------------------------------------------ pages


PAGE = """<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><form><p>Sign up</p></form>
<article><h1>{0}</h1><p><b>One &amp; two<br><p>Third   par\n agraph {1}</p><aside>More</aside><p>Same words here.</p>
<section class="comments"><p>First!</p></section></article><!-- x --><footer>&copy; y</footer></body></html>"""


def test_page_text_is_the_article(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(f"Title {i}", "x < y &lt; &eacute;" + str(i))) for i in range(8)]
    rows += [(20, None, None), (21, "x", ""), (None, "http://u@h2.example:80/a", "<p>only <i>this</i> &#233;&nbsp;<p>and that"), (22, "http://h3.example", "a < b")]
    rows += [(30 + i, "http://copies.example/", "<article><p>all alike</p></article>") for i in range(9)]
    found = {r["page_id"]: r for r in H.main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")).collect()}
    assert len(found) == len(rows)
    # "One & two" and "Same words here." stand once on every page, but among the article's own paragraphs
    assert found[3]["text"] == "Title 3\nOne & two\nThird par agraph x < y < é3\nSame words here."
    assert found[20]["text"] == found[21]["text"] == "" and found[20]["n_chars"] == 0
    assert found[None]["text"] == "only this é\nand that" and found[None]["n_chars"] == 20
    assert found[22]["text"] == "a < b"
    assert {found[30 + i]["text"] for i in range(9)} == {"all alike"}
    assert H.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_of_the_test_pages(spark):
    import html as markup
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in H.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(markup.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert found[r["page_id"]] == "\n".join(p for p in parts if p)


def test_template_classes_nest(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(f"Title {i}", str(i))) for i in range(8)]
    params = H.TemplateParams()
    found = H.template(H.occurrences(spark.createDataFrame(rows, "page_id long, url string, html string"), params), params).toPandas()
    root = found[found["is_root"]]
    # title, header, menu, notice, form, two paragraphs, aside, comment, footer; not the varying title and paragraph
    assert root["class"].nunique() == 1 and root["is_text"].sum() == 10
    plan = H.plans(H.template(H.occurrences(spark.createDataFrame(rows, "page_id long, url string, html string"), params), params), params).first()
    assert plan["container"] == "/html/body/article" and not plan["texts"]
    assert set(plan["parts"]) == {"/html/body/article/aside", "/html/body/article/section.comments"}


def test_nested_classes_decide_slots(spark):
    # the box stands on 7 of 9 pages, under a name that no list has, on pages without an article
    box = "<div class='zyx'><p>Get our app today</p></div>"
    rows = [(i, f"http://boxes.example/{i}", f"<body><div class='qq'><p>Story {i} is new</p></div>{box if i > 1 else ''}</body>") for i in range(9)]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Story {i} is new" for i in range(9)}


#: No article element and no telling name; varying advert, menu and comments.
NEUTRAL = """<html><head><title>{t}</title></head><body><div class="a1"><p><a href="/">{m}</a></p><p>Our site</p></div><div class="b2"><p>{ad}</p></div>
<div class="c3"><div class="d4"><h1>{t}</h1><p>{one}</p><ul><li>{two}</li><li>Point</li></ul><p>Shared by all.</p><div class="g7"><p>Read more of our site.</p></div></div>
<div class="e5"><h3>Opinions</h3>{said}</div></div><div class="f6"><p>All rights {m}</p><p>Imprint</p></div></body></html>"""


def neutral_pages(n):
    rows, wanted = [], {}
    for i in range(n):
        words = " ".join(f"w{i}x{k}" for k in range(40))
        said = "".join(f"<div class='k8'><span class='u'>User {i}-{k}</span><p>Opinion {k} of {i}</p></div>" for k in range(i % 4))
        rows.append((i, "https://neutral.example/p", NEUTRAL.format(t=f"Story {i}", m=f"Menu {i}", ad=f"Buy {i} now", one=words, two=f"Item {i}", said=said)))
        wanted[i] = f"Story {i}\n{words}\nItem {i}\nPoint\nShared by all."
    return rows, wanted


def test_neutral_names_go_by_class_alone(spark):
    rows, wanted = neutral_pages(12)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in H.main_text(pages).collect()}
    assert found == wanted
    # names alone keep the advert, the comments and the shared box
    assert all(H.page_text(html, None, H.TemplateParams()) != wanted[i] for i, _, html in rows)
    # plans too many to be sent to every task: joined by host and salt
    salted = {r["page_id"]: r["text"] for r in H.main_text(pages, sent_bytes=0).collect()}
    assert salted == wanted


def test_comments_inside_the_container_are_records(spark):
    # body text stands beside the list of comments, in one part: only the repeated class tells them apart
    said = "<div class='r'><div class='who'>Name {0}{1}</div><div class='said'>Said {0}{1}</div></div>"
    page = "<body><div class='z'><h1>T{0}</h1><p>{1}</p><div class='q'>{2}</div></div></body>"
    rows = [(i, "http://r.example", page.format(i, f"long {i} " * 40, "".join(said.format(i, k) for k in range(1 + i % 3)))) for i in range(9)]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"T{i}\n" + " ".join([f"long {i}"] * 40) for i in range(9)}
    # sections with headings, and records that are most of the text, are the article
    page = "<body><div class='z'><p>Start {0}</p><div class='q'>{1}</div></div></body>"
    part = "<section><h2>H{0}{1}</h2><p>Words {0}{1}</p></section>"
    rows = [(i, "http://s.example", page.format(i, "".join(part.format(i, k) for k in range(1 + i % 3)))) for i in range(9)]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: "\n".join([f"Start {i}", *(f"{w}{i}{k}" for k in range(1 + i % 3) for w in ("H", "Words "))]) for i in range(9)}


def test_classes_outweigh_names_around_the_container(spark):
    # the whole page in a form, the story in a part called sidebar; one page of another make
    page = "<body><form id='main-form'><div class='menu'><p>Menu</p></div><div class='right-sidebar'><h1>T{0}</h1><p>Story {0} is long enough</p></div></form></body>"
    rows = [(i, None, page.format(i)) for i in range(8)] + [(90, None, "<body><article><p>Other</p></article></body>")]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"T{i}\nStory {i} is long enough" for i in range(8)} | {90: "Other"}


def test_names_never_drop_an_article():
    params = H.TemplateParams()
    for page in ("<article class='post promoted'><p>Long story</p></article>", "<div class='layout with-sidebar'><article><p>Long story</p></article></div>",
                 "<div class='widget'><main><p>Long story</p><div class='share'>Share</div></main></div>"):
        assert H.page_text(page, None, params) == "Long story", page
    assert H.page_text("<article><p>Story</p></article><div id='comments'><article><p>First!</p></article></div>", None, params) == "Story"
    assert H.page_text("<nav><article><p>Menu</p></article></nav><p>Story</p>", None, params) == "Story"


def test_near_copies_odd_pages_and_numbered_parts(spark):
    common = [f"Paragraph {k} of the one article that all these pages copy." for k in range(6)]
    rows = [(i, "http://near.example/", "<article>" + "".join(f"<p>{c}</p>" for c in common) + f"<p>Changed {i}</p></article>") for i in range(8)]
    # a third of the host are pages without tokens or of another make: the others keep their template
    numbered = "<body><div class='qq'><p>Line of every page</p></div><div id='post-{0}'><p>Own story {0}</p></div></body>"
    rows += [(100 + i, "http://odd.example/", numbered.format(i)) for i in range(10)]
    rows += [(110, "http://odd.example/", None), (111, "http://odd.example/", ""), (112, "http://odd.example/", "plain"), (113, "http://odd.example/", "<p>x")]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in range(8)] == ["\n".join([*common, f"Changed {i}"]) for i in range(8)]
    assert [found[100 + i] for i in range(10)] == [f"Own story {i}" for i in range(10)]
    assert [found[i] for i in (110, 111, 112, 113)] == ["", "", "plain", "x"]
    paths = [H.blocks(numbered.format(i))[0][1].path for i in (1, 2)]
    assert paths[0] == paths[1]


# ------------------------------------------------------------------ helpers and pipeline


def test_words_and_hashes():
    texts = [b"", b" a  b\n", "é\tß a b".encode(), b"", b"a"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    starts, ends, at = C.words(data, offsets)
    split = [[data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(at[:-1], at[1:])]
    assert split == [t.split() for t in texts]
    hashes = C.word_hashes(data, starts, ends)
    names = [w for t in split for w in t]
    assert all((hashes[i] == hashes[j]) == (names[i] == names[j]) for i in range(len(names)) for j in range(len(names)))


def test_bitmap_has_every_key(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    marks = C.bitmap(spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(4), "k")
    assert C.in_bitmap(marks, keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000)
    assert C.in_bitmap(marks, others.view(np.uint64)).mean() < 0.01


def test_scratch_folder_is_required_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        C.shared_dir(Session())


def test_pipeline_stages_on_the_test_table(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("node", F.lit("x")).cache()
    columns = docs.columns
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns, name
        if name == "ngram_jaccard_join":
            before = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert {r["doc_id"] for r in out.collect()} == {c if n else i for i, n, c in B.similar(before)}
        if name == "pii":
            assert out.count() == docs.count() and out.where("n_chars <> length(text)").count() == 0
        if name == "toxicity":
            assert out.count() >= docs.count() - len(toxic) - 5
        docs = out
    used, least = check_places(P.STAGES[-1][1](spark, docs, SF).collect())
    assert used <= least + 1


def test_workers_drop_what_packing_learnt():
    from larder.llm import common, packing
    from larder.llm.queries import tokenizer_path

    vocabulary = packing.Vocabulary.of(tokenizer_path())
    assert packing.Vocabulary.of(tokenizer_path()) is vocabulary
    common.release()
    assert packing.Vocabulary.of(tokenizer_path()) is not vocabulary
