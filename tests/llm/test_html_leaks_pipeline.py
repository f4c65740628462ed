"""Main text of pages, benchmark leaks, and the pipeline."""

import html as markup
import random
import re

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from lineage_spark.llm import decontaminate, html_extract, jaccard
from lineage_spark.llm.common import words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_pages_of_the_tables(spark):
    import __spark_entry__ as entry
    got = {r["page_id"]: r for r in entry.queries()["op9_html"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    same = 0
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p["html"], re.S)[1]
        want = " ".join(markup.unescape(re.sub(r"</?b>", "", re.sub(r"<(/?(p|h1|br)\b)[^>]*>", " ", inner))).split())
        same += got[p["page_id"]]["text"] == want
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])
    assert same >= 0.98 * len(pages)


def test_other_layouts(spark, labeller):
    rows = [
        (1, "<body><header><div>Site</div></header><div class='cookie-notice'><p>We use cookies here.</p></div><main><h1>A &amp; B</h1>"
            "<p>First\n  part of <i>the</i> text&nbsp;x.</p><form><label>Your mail</label></form><p>Second part of it &lt;3.</p>"
            "<script>var x='</p>';</script><!-- <p>hidden</p> --></main><section id='comments'><p>I like it very much.</p></section>"
            "<aside><p>Other stories</p></aside><footer>Copyright</footer></body>",
         "A & B First part of the text x. Second part of it <3."),
        (2, None, ""), (3, "", ""), (4, "<nav><a href='x'>Menu</a></nav>", ""),
        (5, "<article><p>" + "long text here. " * 20000 + "</p></article>", ("long text here. " * 20000).strip()),
        (6, "<article><p>cut <b>off in the <a href=\"x>y\">middle", "cut off in the middle"),
    ]
    df = spark.createDataFrame([(i, h, "t") for i, h, _ in rows], "page_id long, html string, main_text string")
    got = {r["page_id"]: r["main_text"] for r in html_extract.extracted(df, labeller).collect()}
    assert got == {i: t for i, _, t in rows}
    assert html_extract.extracted(df.where("false"), labeller).count() == 0


def test_training_without_pages(spark):
    empty = spark.read.parquet(f"{SF}/pages.parquet").where("false")
    model = html_extract.train(empty)
    df = spark.createDataFrame([(1, "<nav>Menu</nav><article><p>Text here.</p></article><footer>End</footer>")], "page_id long, html string")
    assert html_extract.extracted(df, model).first()["main_text"] == "Text here."


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    net = html_extract.Labeller.fresh()
    x = r.standard_normal((3, 5, html_extract.DIMS))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    y = r.integers(0, 2, (3, 5)).astype(float)

    def loss():
        p = html_extract._sigmoid(net._logits(x, mask)[0])
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for k in net.NAMES:
        for _ in range(3):
            at = tuple(r.integers(0, s) for s in net.w[k].shape)
            old = net.w[k][at]
            net.w[k][at] = old + 1e-5
            up = loss()
            net.w[k][at] = old - 1e-5
            down = loss()
            net.w[k][at] = old
            assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j], row[j + 1]))
    return row[-1]


def test_lcs_matches_dynamic_programming():
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randint(1, 8) for _ in range(r.randint(1, 70))] for _ in range(2))
        masks = {}
        for i, t in enumerate(a):
            masks[t] = masks.get(t, 0) | (1 << i)
        assert decontaminate.lcs_length(masks, len(a), b) == lcs(a, b)


def leak_corpus(seed):
    r = random.Random(seed)
    common = "the of and to in a is that it on was for".split()
    word = lambda: r.choice(common) if r.random() < 0.4 else f"x{r.randrange(3000)}"
    items = [(i, [word() for _ in range(r.randint(5, 60))]) for i in range(30)]
    docs, planted = [], set()
    for d in range(250):
        body = [word() for _ in range(r.randint(0, 300))]
        if d % 5 == 0:
            i, w = r.choice(items)
            copy = list(w)
            if d % 10 == 0 and len(copy) >= 20:  # a paraphrase: some words exchanged, one added
                for _ in range(len(copy) // 10):
                    copy[r.randrange(len(copy))] = word()
                copy.insert(r.randrange(len(copy)), "indeed")
            at = r.randint(0, len(body))
            body[at:at] = [x.upper() if d % 15 == 0 else x for x in copy]
            planted.add((d, i))
        docs.append((d, " ".join(body)))
    return docs, [(i, " ".join(w)) for i, w in items], planted


@pytest.mark.parametrize("seed,block", [(1, 4 << 20), (2, 600)])
def test_recall_of_planted_passages(spark, monkeypatch, seed, block):
    """Recall against the planted pairs is 0.9 or more, with items in one block or in several; clean documents stay."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items, planted = leak_corpus(seed)
    df = spark.createDataFrame([(d, t, "a", "b") for d, t in docs], "doc_id long, text string, key string, __a string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["key"], r["item"]) for r in decontaminate.leaks(df, bench).collect()}
    assert len(got & planted) >= 0.9 * len(planted)
    assert not got - planted
    left = decontaminate.without_leaks(df, bench)
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_leak_edge_cases(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, item.upper()), (4, item.upper()), (None, "x " * 50000 + item),
                                  (5, "two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two three"), (5, item)], "item_id long, text string")
    got = sorted(((r["key"], r["item"]) for r in decontaminate.leaks(docs, bench).collect()), key=str)
    assert got == sorted([(4, 1), (4, 5), (4, 1), (4, 5), (None, 1), (None, 5)], key=str)
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.without_leaks(docs, bench.where("false")).count() == docs.count()


def test_answer_column(spark):
    body = "who wrote the book about the long road to the sea and the old ship that never came home"
    docs = spark.createDataFrame([(1, f"{body} it was marlowe indeed"), (2, f"{body} and nobody knows")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, body, "Marlowe")], "item_id long, text string, answer string")
    assert [r["key"] for r in decontaminate.leaks(docs, bench, answer="answer", min_answer=1.0).collect()] == [1]
    assert decontaminate.leaks(docs, bench, answer="answer", min_answer=0.0).count() == 2


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "leaks", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert out.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in out.select("doc_id", "text").collect()}
        before, docs = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}, out
        assert kept[name].items() <= before.items()
        if name == "exact":
            groups = {}
            for i, t in before.items():
                groups.setdefault(t.encode().lower(), []).append(i)
            assert set(kept[name]) == {max(g) for g in groups.values()}
        if name == "near":
            assert len(kept[name]) == len(set(classes(before)))
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in final} == set(kept["leaks"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, final))


def classes(texts):
    """Component of every text, by comparing all pairs."""
    ids, sets = list(texts), []
    for i in ids:
        sets.append(jaccard.grams(texts[i], 5))
        assert len(sets[-1]) == len({tuple(words_of(texts[i])[j:j + 5]) for j in range(max(1, len(words_of(texts[i])) - 4))})
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if label[i] != label[j] and 1.25 * len(sets[i]) >= len(sets[j]) >= 0.8 * len(sets[i]) and jaccard.links_exactly(sets[i], sets[j], 80):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def test_pipeline_on_nothing_and_nulls(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], base.schema)
    for docs in (base.where("false"), odd):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), "edge")
        assert docs.count() <= 2


def found_by_index(items, docs, dims=8, min_lcs=0.7):
    """(document, item) pairs of the search over lists of word numbers, without Spark."""
    features = max(map(max, items)) + 1
    rows = []
    for i, w in enumerate(items):
        masks = {}
        for at, t in enumerate(w):
            masks[t] = masks.get(t, 0) | (1 << at)
        rows.append(decontaminate._Item(i, np.array(w, np.int32), set(w[:5]), masks))
    idf = np.ones(features)
    idf[0] = 0.0
    basis = np.random.default_rng(1).standard_normal((features, dims)).astype(np.float32)
    index = decontaminate._Index(rows, idf, basis, 0.7, min_lcs, 0.5)
    batch = pd.DataFrame({"key": range(len(docs)), "__a": 0, "__b": 0, "ids": [np.array(d, np.int32).tobytes() for d in docs]})
    return {(r.key, r.item) for out in index.search([batch]) for r in out.itertuples()}


def test_rare_words_may_be_replaced(spark):
    """Without an answer column a copy whose rarest words are replaced is still a copy."""
    r = random.Random(7)
    common = [f"w{i}" for i in range(200)]
    item = [r.choice(common) for _ in range(33)] + ["rarea", "rareb", "rarec", "rared", "raree"]
    r.shuffle(item)
    copy = [w if w not in ("rarea", "rareb", "rarec") else "other" for w in item]
    docs = [(i, " ".join(r.choice(common) for _ in range(120))) for i in range(40)]
    docs.append((100, docs[0][1] + " " + " ".join(copy) + " " + docs[1][1]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert [(r["key"], round(r["lcs_share"], 2)) for r in decontaminate.leaks(df, bench).collect()] == [(100, 0.92)]


def test_every_length_and_offset():
    """Copies of an LCS of 0.7 to 0.8 are found at any length and offset, whether the other words are benchmark words or unknown."""
    r = random.Random(11)
    items = [[r.randrange(1, 2000) for _ in range(n)] for n in range(decontaminate.DENSE_WORDS, 61)]
    docs, want = [], set()
    for i, w in enumerate(items):
        for offset in range(16):
            for block in (True, False):
                exchanged = len(w) - decontaminate.least_common(0.7, len(w))
                first = (len(w) - exchanged) // 2
                at = range(first, first + exchanged) if block else r.sample(range(len(w)), exchanged)
                copy = [r.choice((0, r.randrange(1, 2000))) if j in at else t for j, t in enumerate(w)]
                want.add((len(docs), i))
                docs.append([0] * (16 + offset) + copy + [0] * 40)
    assert found_by_index(items, docs) >= want


def test_words_outside_the_sample(spark, monkeypatch):
    """With a sample far smaller than the corpus, a copy is found and near its item whatever its words are."""
    monkeypatch.setattr(decontaminate, "SVD_PASSAGES", 2)
    docs, items, planted = leak_corpus(5)
    rare = [(900 + i, " ".join(f"r{i}q{j}" for j in range(20))) for i in range(5)]
    docs += [(1000 + i, "the of and " * 40 + t + " to in a" * 40) for i, (_, t) in enumerate(rare)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + rare, "item_id long, text string")
    got = {(r["key"], r["item"]): r["cosine"] for r in decontaminate.leaks(df, bench).collect()}
    assert planted | {(1000 + i, 900 + i) for i in range(5)} <= set(got)
    assert all(got[1000 + i, 900 + i] > 0.9 for i in range(5))


def test_basis_is_fitted_on_every_passage(spark, monkeypatch):
    """The basis is the range of the TF-IDF matrix of all passages, however few are multiplied at a time."""
    r = random.Random(3)
    topics = [range(1 + 8 * t, 9 + 8 * t) for t in range(4)]
    texts = [[r.choice(topics[i % 4]) for _ in range(r.choice([0, 5, 16, 40]))] for i in range(300)]
    texts += [[33, 34] * 8]  # one passage in some hundred
    idf = np.concatenate([[0.0], np.linspace(1.0, 2.0, 34)])
    rows = []
    for w in texts:
        for at in decontaminate._starts(len(w), decontaminate.WINDOW, decontaminate.WINDOW):
            rows.append(np.bincount(w[at:at + decontaminate.WINDOW], minlength=35) * idf)
    a = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    df = spark.createDataFrame([(np.array(w, np.int32).tobytes(),) for w in texts], "ids binary").repartition(3)
    for chunk in (1, 7, 100_000):
        monkeypatch.setattr(decontaminate, "SVD_PASSAGES", chunk)
        basis = decontaminate.randomised_basis(df, idf, 34).astype(float)
        assert np.abs(basis.T @ basis - np.eye(34)).max() < 1e-4
        assert np.abs(a - a @ basis @ basis.T).max() < 1e-3


def test_words_in_bytes_are_the_tokens():
    r = random.Random(5)
    letters = "abAB09_ \n\t.,-'\x1c\x85ßſñÉİ²٣é—“”\u00a0\u2028"
    for text in [None, "", "—", "İstanbul — “quoted” naïve ab_c x9", *("".join(r.choices(letters, k=60)) for _ in range(300))]:
        assert [w.decode() for w in decontaminate.word_bytes(text)] == decontaminate.tokens(text)


def test_products_are_those_of_the_whole_matrix():
    """Passages are regrouped by known words; the sums are those of a plain product, empty and repeated words included."""
    r = np.random.default_rng(4)
    texts = [(r.integers(0, 12, int(r.integers(0, 90))) * (r.random() < 0.9)).astype(np.int32) for _ in range(60)]
    idf, basis = np.append(0.0, r.random(11) + 1), r.standard_normal((12, 5)).astype(np.float32)
    rows = []
    for p in np.concatenate([decontaminate._passages(t, 16, 16)[1] for t in texts]):
        v = np.bincount(p, minlength=12) * idf
        rows.append(v / max(np.linalg.norm(v), 1e-9))
    a = np.array(rows)
    frame = pd.DataFrame({"ids": [t.tobytes() for t in texts]})
    for chunk in (3, 1024):
        out = pd.concat(decontaminate._gram_product(idf, basis, 16, chunk)(iter([frame])))
        got = np.frombuffer(out["sums"].iloc[0]).reshape(12, 5)
        assert np.allclose(got, a.T @ (a @ basis), atol=1e-4)
