"""SimHash, toxicity, main text, nearest neighbours and the pipeline against brute force or held-out rows."""

import random
import zlib
from collections import Counter

import numpy as np
import xxhash
from conftest import SF

import corpus_pipeline
from gleaner.llm import hnsw, html, queries, simhash, toxicity

DOC = "doc_id long, text string, lang string, fp int, id string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", 5, "clash") for i, t in enumerate(texts)], DOC)


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        bits.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def plain_components(prints, budget=3):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= budget:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_texts(seed=4):
    random.seed(seed)
    base = [[random.choice("abcdefghijklmnop") + str(random.randrange(40)) for _ in range(400)] for _ in range(25)]
    texts = [None, "", "  ", "One two", "ONE TWO", "É é", "one\x0btwo\x0cthree four", "word " * 5000]
    for words in base:
        texts.append(" ".join(words))
        for _ in range(5):
            words = list(words)
            words[random.randrange(len(words))] = "zz" + str(random.random())
            texts.append(" ".join(words))
        texts.append(texts[-1])
    return texts


def test_simhash_components_equal_brute_force(spark):
    texts = near_texts()
    rows = simhash.near_duplicates(frame(spark, texts)).collect()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {r["id"]: r["fp"] & (2**64 - 1) for r in rows} == prints
    want = plain_components(prints)
    assert {r["id"]: r["component_id"] for r in rows} == want and len(rows) == len(texts)
    assert 1 < len(set(want.values())) < len(texts) - 30
    kept = simhash.keep_one(frame(spark, texts))
    assert kept.columns == frame(spark, []).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_empty_and_repeated(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    twice = frame(spark, ["some words of text here", "other"]).union(frame(spark, ["some words of text here", "other"]))
    assert simhash.keep_one(twice).count() == 2
    nameless = spark.createDataFrame([(None, "a", "en", 1, "x")] * 2, DOC)
    assert simhash.keep_one(nameless).count() == 2


def test_crowded_blocks_are_cut_again(spark, monkeypatch):
    """With a tiny group size every block is crowded; the result stays the same."""
    prints = {}
    random.seed(6)
    for i in range(300):
        seed = random.randrange(12)
        value = (seed << 48) | (random.Random(seed).getrandbits(48))
        for _ in range(random.randrange(4)):
            value ^= 1 << random.randrange(48)
        prints[i] = value
    first = {}
    for i, p in prints.items():
        first.setdefault(p, i)
    signed = lambda p: p - 2**64 if p >= 2**63 else p
    nodes = spark.createDataFrame([(i, signed(p)) for p, i in first.items()], "rep long, fp long")
    want = {i: c for i, c in plain_components(prints).items() if i in first.values()}
    monkeypatch.setattr(simhash, "GROUP_ROWS", 3)
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes)).collect()}
    assert {i: found.get(i, i) for i in want} == want


def test_components_of_long_chains(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 300)] + [(1000, 7)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert set(found.values()) == {0} and len(found) == 200 + 300


def test_trie_walk_equals_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    keys = [base]
    for _ in range(6):
        other = base.copy()
        for _ in range(3):
            other ^= np.uint64(1) << rng.integers(0, 64, len(other)).astype(np.uint64)
        keys.append(other)
    keys = np.unique(np.concatenate(keys))
    found = [tuple(sorted(p)) for part in simhash.trie_pairs(keys, 0, 3, at_once=20) for p in part.T.tolist()]
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if int(keys[i] ^ keys[j]).bit_count() <= 3}
    assert len(found) == len(set(found)) and set(found) == want


# Toxicity ---------------------------------------------------------------------------

INSULTS = ["idiot", "scum", "moron", "loser"]


def toxic_corpus(spark, n=600):
    random.seed(8)
    plain = "the a of and to in is that for with was under over near some many few stone water light house river mountain".split()
    rows, labels = [], []
    for i in range(n):
        words = [random.choice(plain) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words[random.randrange(60)] = random.choice(INSULTS)
        rows.append((i, " ".join(words), "en", 5, "x"))
        labels.append((i, 1, int(toxic)))
    return (
        spark.createDataFrame(rows, DOC),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_disguises_are_undone(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.ToxicityModel.train(docs, labels)
    tricky = [
        "you 1d10t of the river", "the water is s c u m here", "some l.o.s.e.r near", "that mooorooon was", "the m0r0n",
        "the river is under the mountain", "h2o and mp3 in 2024 cost 3.50$!!", None, "", "the stone 4 5 6 7 8", "IDIOT!!!",
    ]
    rows = {r["id"]: r for r in model.score(frame(spark, tricky), with_text=True).collect()}
    toxic = {i for i, r in rows.items() if r["score"] >= 0.5}
    assert toxic == {0, 1, 2, 3, 4, 10}
    assert "idiot" in rows[0]["restored"] and "scum" in rows[1]["restored"] and "loser" in rows[2]["restored"]
    assert rows[5]["restored"] == tricky[5] and rows[7]["restored"] == ""
    kept = model.filter_documents(frame(spark, tricky))
    assert kept.columns == frame(spark, []).columns and {r["doc_id"] for r in kept.collect()} == set(rows) - toxic
    scored = {r["id"]: r["score"] >= 0.5 for r in model.score(docs).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and all(scored[i] == (i % 4 == 0) for i in held)


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = toxic_corpus(spark, 20)
    none = toxicity.ToxicityModel.train(docs, labels.limit(0))
    assert all(r["score"] < 0.01 for r in none.score(docs).collect())
    assert none.score(docs.limit(0)).count() == 0
    empty = toxicity.ToxicityModel.train(docs.limit(0), labels)
    assert empty.score(frame(spark, [None, "x"])).count() == 2
    sample = toxicity.labelled_sample(docs.union(docs), labels.union(labels.selectExpr("doc_id", "quality", "null")), 7)
    assert sample.count() == 7 and sample.select("id").distinct().count() == 7


def test_viterbi_finds_the_best_path():
    """Against every path of small lattices."""
    rng = np.random.default_rng(3)
    model = toxicity.CharacterModel(np.log(rng.dirichlet(np.ones(toxicity.ALPHABET), (toxicity.ALPHABET,) * 2)))
    for written in ("1d1", "$@a", "aab", "0x!", "sss1"):
        paths = [((0, 0), 0.0, "")]
        for options in toxicity.lattice(written):
            paths = [
                ((b, c), s + cost + model.logp[a, b, c], w + toxicity.LETTERS[c - 1]) if c else ((a, b), s + cost, w)
                for (a, b), s, w in paths
                for c, cost in options
            ]
        score, word = max((s + model.logp[a, b, 0], w) for (a, b), s, w in paths if w)
        likely = score / (len(word) + 1) >= toxicity.FLOOR
        assert toxicity.decode(written, model) == (word if likely else written)


# Pages ------------------------------------------------------------------------------

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/'>home</a></li></ul></nav><!-- <p>no</p> --><div class=\"ad\">buy this now</div>"
    "<article><h1>A &amp; B</h1><p><b>First   one<br>more &lt;i&gt; <p>second\n one &eacute;</p><div class='ad-slot'>buy that</div>"
    "<p>third</p><section id=comments><p>great post</p></section></article><form><p>sign up</p></form><footer>&copy; x</footer>"
)


def pages(spark, texts):
    return spark.createDataFrame([(i, f"u{i}", t, "x", "y") for i, t in enumerate(texts)],
                                 "page_id long, url string, html string, text string, id string")


def test_main_text(spark):
    texts = [PAGE] * 8 + [None, "", "<p>", "no tags at all here", "<article>" + "<p>long words</p>" * 20_000, "<a <b < 3 & x"]
    found = pages(spark, texts)
    rows = {r["id"]: r["text"] for r in html.extract(found, html.fit(found)).collect()}
    assert rows[0] == "A & B\nFirst one more <i>\nsecond one é\nthird"
    assert rows[8] == rows[9] == rows[10] == "" and rows[11] == "no tags at all here"
    assert rows[12] == "\n".join(["long words"] * 20_000) and len(rows) == len(texts)
    assert html.extract(pages(spark, []), html.fit(pages(spark, []))).count() == 0


def test_pages_without_article_element():
    page = (
        "<body><header><a>Site</a> motto here</header><div id='content'><p>One two three four five.</p><aside>not this</aside>"
        "<p>Six seven eight.</p></div><div class='cookie-banner'>we use cookies</div><div class='sidebar'>links links</div></body>"
    )
    assert html.extract_text(page, html.Weights()) == "One two three four five.\nSix seven eight."


def test_best_run_equals_all_runs():
    rng = np.random.default_rng(5)
    for _ in range(200):
        scores = rng.integers(-3, 4, rng.integers(0, 12)).astype(float).tolist()
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
        start, end = html.best_run(scores)
        assert sum(scores[start:end]) == max(best, 0)


# Vectors ----------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, v int")


def test_nearest_vectors(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(900, 16)).astype(np.float32)
    points[100:400] = points[0]  # one vector holds a third of the rows
    rows = [(i, p.tolist(), 0, "x", 1) for i, p in enumerate(points)]
    bad = [(2000, None, 0, "x", 1), (2001, [0.0] * 16, 0, "x", 1), (2002, [float("nan")] * 16, 0, "x", 1),
           (2003, [None] + [1.0] * 15, 0, "x", 1), (2004, [], 0, "x", 1), (2005, [1.0, 2.0], 0, "x", 1), (2006, [1.0, 2.5], 0, "x", 1)]
    found = hnsw.vectors_of(vectors(spark, rows + bad + rows[:5]), "vec_id", "embedding")
    index = hnsw.shard_index(found, keep_ids=11, shard_rows=300)
    assert index.count() > 2
    asked = found.where("id % 100 = 0 or id in (2005, 2006)")
    got = {}
    for r in hnsw.search_index(index, asked, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    exact, hits = points.astype(np.float64), 0
    for q in range(0, 900, 100):
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        want = sorted((s, i) for i, s in enumerate(d.tolist()) if i != q)[:10]
        assert all(abs(s - d[i]) < 1e-12 for i, s in got[q]) and len(got[q]) == 10
        hits += len({i for _, i in want} & {i for i, _ in got[q]})
    assert hits >= 0.9 * 90
    assert [i for i, _ in got[100]] == [0, *range(101, 110)]
    assert [i for i, _ in got[2005]] == [2006]
    none = hnsw.shard_index(found.limit(0), 11)
    assert hnsw.search_index(none, asked, 10).count() == 0


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    hits = total = 0
    found = {}
    for r in queries.op9_nearest_vectors(spark, SF).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    for q in found:
        d = ((points - points[ids == q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits += len(found[q] & set(ids[np.argsort(d, kind="stable")[:10]].tolist()))
        total += 10
    assert hits >= 0.9 * total and len(found) == sum(i % 100 == 0 for i in ids.tolist())


def test_disguises_of_any_length_and_several_words():
    plain = "you are an idiot and this is what the people say about the other people of this place " * 50
    codes, counts = np.unique(toxicity.trigram_counts(plain + "hello letter all too "), return_counts=True)
    restorer = toxicity.Restorer(toxicity.CharacterModel.of(codes, counts.astype(float)))
    spelled = lambda t: " ".join(t.replace(" ", ""))
    assert "idiot" in restorer.words(spelled("you are an idiot"))[1]
    long = restorer.words(spelled("this is what the people say about the other people and you are an idiot and the people say this"))[1]
    assert {"idiot", "people", "about"} <= long
    assert restorer.text("i d i o t!").startswith("idiot") and restorer.text("i d i o t") == "idiot"
    assert restorer.text("an iiddiioott") == "an idiot" and "idiot" in restorer.words("an iddiot")[1]
    text, words = restorer.words("letter")
    assert text == "letter" and "letter" in words
    assert restorer.text("1d1ot" * 40) != "1d1ot" * 40


# Pipeline ---------------------------------------------------------------------------


def test_pipeline_equals_plain_steps(spark):
    """Each stage on what the one before kept, against the plain definitions of its decisions."""
    folder, docs = SF, spark.read.parquet(f"{SF}/documents.parquet")
    names, columns = dict(corpus_pipeline.STAGES), docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.ToxicityModel.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r["id"] for r in model.score(docs).collect() if r["score"] >= 0.5}
    stage = names["toxicity"](spark, docs, folder)
    assert stage.columns == columns and {r["doc_id"] for r in stage.collect()} == set(before) - toxic
    ruled = names["quality_rules"](spark, docs, folder)
    kept = {r["doc_id"] for r in queries.op4_quality_rules(spark, folder).collect() if r["kept"]}
    assert ruled.columns == columns and {r["doc_id"] for r in ruled.collect()} == kept
    single = names["simhash"](spark, ruled, folder)
    want = set(plain_components({i: plain_fingerprint(before[i]) for i in kept}).values())
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == want
    clean = names["pii"](spark, single, folder)
    rows = clean.collect()
    assert clean.columns == columns and {r["doc_id"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) and "@" not in r["text"] for r in rows)
    packed = names["packing"](spark, clean, folder)
    assert {r["doc_id"] for r in packed.collect()} == want
    assert corpus_pipeline.ORACLE_SQL is None and list(names)[0] == "toxicity"


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({(r["doc_id"], r["start"]) for r in rows}) == len(rows)
