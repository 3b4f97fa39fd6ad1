"""Classifiers by held-out accuracy, secrets and benchmark passages by planted cases, the pipeline by its parts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import decontaminate, neighbours, queries, secrets, toxicity
from tallyframe.llm.rowwise import in_training

SF = "/root/testdata/sf0.01"


def held_out(spark, query, label):
    scored = queries.QUERIES[query](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "predicted", F.col(label).alias("label")).collect()
    assert scored.count() == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    return rows


def test_quality_held_out(spark):
    rows = held_out(spark, "op4_quality_neighbours", "quality")
    assert sum(r["predicted"] == r["label"] for r in rows) >= 0.97 * len(rows)


def test_toxicity_held_out(spark):
    rows = held_out(spark, "op3_toxicity_machine", "toxic")
    assert not sum(r["predicted"] > r["label"] for r in rows) > 0.02 * len(rows)
    assert sum(r["predicted"] for r in rows if r["label"]) >= 0.6 * sum(r["label"] for r in rows)


def test_machine_learns_pairs():
    """A label that only a pair of terms gives: each term alone is as frequent in either class."""
    rng = np.random.default_rng(2)
    rows = [np.unique(np.concatenate([rng.integers(10, 60, 6), *([[1]] if a else []), *([[2]] if b else [])])).astype(np.int32)
            for a, b in rng.integers(0, 2, (800, 2))]
    y = np.array([float((1 in r) == (2 in r)) for r in rows], np.float32)
    held = np.array([np.isin(np.arange(64), r) for r in rows])
    chosen = toxicity.choose(np.arange(64), held[y == 1].sum(0).astype(float), held[y == 0].sum(0).astype(float), int(y.sum()), int((1 - y).sum()), 60, 1)
    machine = toxicity.fit([np.intersect1d(r, chosen).astype(np.int32) for r in rows], y, 64, chosen)
    scores = np.array([machine.score(r) for r in rows])
    assert {1, 2} <= set(machine.chosen.tolist()) and ((scores > 0.5) == (y == 1)).mean() > 0.9


@pytest.mark.parametrize("module", ["toxicity", "quality"])
def test_classifier_edges(spark, module):
    docs = spark.createDataFrame(
        [(1, "good words here.", 0.5), (2, "bad idiot words", 0.5), (None, None, 0.5), (3, "", 0.5), (3, "", 0.5), (4, "x " * 100_000, 0.5)],
        "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    train, score = (toxicity.train, toxicity.score_toxicity) if module == "toxicity" else (neighbours.train, neighbours.score_quality)
    for known in (labels, labels.limit(0)):
        rows = score(docs, train(docs, known)).collect()
        assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (None, 3)}) == 1
    assert score(docs.limit(0), train(docs.limit(0), labels)).count() == 0


def secret_docs(spark):
    rng = random.Random(8)
    code = lambda n, letters="0123456789abcdef": "".join(rng.choice(letters) for _ in range(n))
    rows, planted = [], {}
    for i in range(300):
        kind = i % 3
        if kind == 0:
            planted[i] = code(40)
            rows.append((i, f'some text before token = "{planted[i]}" and after it.', "src/a.env"))
        elif kind == 1:
            rows.append((i, f"the commit {code(40)} and the unconstitutionally long understatementing word", "docs/x"))
        else:
            rows.append((i, f"call 4{code(15, '0123456789')} or see internationalisation pages", None))
    return rows, planted


def test_secrets(spark):
    rows, planted = secret_docs(spark)
    edges = [(None, f'token = "{planted[0]}"', "p"), (1000, None, None), (1001, "", ""), (0, rows[0][1], "src/a.env"), (1002, "word " * 60_000, "p")]
    df = spark.createDataFrame([(*r, 0.1) for r in rows + edges], "doc_id long, text string, source string, probability double")
    found = secrets.scan(df).where("is_secret").collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["token"]) for r in found) == sorted(
        [*planted.items(), (0, planted[0]), (-1, planted[0])])
    clean = {(r["doc_id"], r["source"]): r["text"] for r in secrets.redact(df).collect()}
    assert clean[(0, "src/a.env")] == 'some text before token = "[SECRET]" and after it.'
    assert clean[(None, "p")] == 'token = "[SECRET]"' and clean[(1000, None)] is None
    assert all(clean[(i, s)] == t for i, t, s in rows if i not in planted)
    assert secrets.redact(df).columns == df.columns and secrets.redact(df).count() == df.count()
    assert secrets.scan(df.limit(0)).count() == 0


def test_secrets_unquoted_bare_and_short(spark):
    """Secrets that carry their own name, of a known form without any name, and short ones; alone in a table, too."""
    rng = random.Random(9)
    code = lambda n, letters="0123456789abcdef": "".join(rng.choice(letters) for _ in range(n))
    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789"
    hidden = [
        (lambda s: f"TOKEN={s}", code(40)), (lambda s: f"export API_KEY={s} next", "7f" + code(38)),
        (lambda s: f"see https://www.example.org/page?id=4&access_token={s}&x=1 there", code(32)),
        (lambda s: f"DB_PASSWORD={s}=", "a1b2=" + code(20)), (lambda s: f"found {s} in the log", "AKIA" + code(16, upper)),
        (lambda s: f"push with {s} then", "ghp_" + code(36, mixed)), (lambda s: f"password: {s}", "hun7er2x"),
        (lambda s: f'{{"passwd": "{s}"}}', "q9w8e7"), (lambda s: f"PWD={s} and pass1word2 stays", "pass1")]
    harmless = [f"commit={code(40)}", f"sha1 {code(40)}", "a=b c=d", "=" * 40, "API_KEY=example1234567890abcdef",
                "the internationalisation_of_everything=yes", *["the key: value of the matter"] * 9]
    rows = [(i, make(s), "a") for i, (make, s) in enumerate(hidden)] + [(100 + i, t, "a") for i, t in enumerate(harmless)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for part in (df, df.unionByName(spark.createDataFrame(secret_docs(spark)[0], df.schema).withColumn("doc_id", F.col("doc_id") + 1000))):
        clean = {r["doc_id"]: r["text"] for r in secrets.redact(part).where("doc_id < 1000").collect()}
        for i, (make, s) in enumerate(hidden):
            assert clean[i] in (make("[SECRET]"), make("[SECRET]").replace("[SECRET]=", "[SECRET]")), (i, clean[i])
        assert [clean[100 + i] for i in range(len(harmless))] == harmless


def test_forest_on_forms_it_never_saw(spark):
    """Precision and recall on names, contexts and forms that no training finding has."""
    rng = random.Random(12)
    hexa, mixed = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    code = lambda n, letters=mixed: "".join(rng.choice(letters) for _ in range(n))
    word = lambda: "".join(rng.choice(["ka", "ter", "lo", "min", "sur", "pa", "del", "ven"]) for _ in range(rng.randrange(2, 5)))
    real = [
        lambda: ("mailer_api_token := \"{}\"", code(36)), lambda: ("AWS_SECRET_ACCESS_KEY={}", code(40)), lambda: ("stripePassword: '{}'", code(14)),
        lambda: ("use {} here", "glpat-" + code(20)), lambda: ("clone with {} now", "npm_" + code(36)), lambda: ("model {} loads", "hf_" + code(34)),
        lambda: ("<add name=\"AuthSecret\" value=x /> secretKey={}", code(48, hexa)), lambda: ("curl -H 'X-Auth-Token: {}'", code(32)),
        lambda: ("REDIS_AUTH={} ok", code(24)), lambda: ("credentials: {}", code(20))]
    fake = [
        lambda: ("tree {} of", code(40, hexa)), lambda: ("build {} done", code(20, hexa)), lambda: ("fixed in {} yesterday", code(40, hexa)),
        lambda: ("the {} way", word() + word() + word() + word() + word()), lambda: ("iban {} please", code(18, "0123456789")),
        lambda: ("token: {} was meant", word()), lambda: ("password must be {} long", word() + word() + word() + word() + word()),
        lambda: ("ticket {} is", "-".join(code(n, hexa) for n in (8, 4, 4, 4, 12))), lambda: ("secret = {}", "your_" + word() + "_secret_goes_here"),
        lambda: ("<img src={}>", "img/" + code(30, hexa) + ".png"), lambda: ("{}", "_".join(word() for _ in range(6)))]
    rows, planted = [], {}
    for i in range(840):
        kind, value = rng.choice(real)() if i % 2 else rng.choice(fake)()
        rows.append((i, " ".join([word(), word(), word(), kind.format(value), word(), word()]), rng.choice(["a/b.yml", "notes.txt", None])))
        if i % 2:
            planted[i] = value
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("is_secret").collect()
    right = sum(planted.get(r["doc_id"]) == r["token"] for r in found)
    print("precision", right / len(found), "recall", right / len(planted))
    assert right >= 0.95 * len(found) and right >= 0.9 * len(planted)


def test_findings_of_a_known_nature(spark):
    made = secrets.made_findings(spark, 40)
    counts = dict(made.groupBy("label").count().collect())
    assert counts[1] > 200 and counts[0] > 250 and made.where("token is null or before is null").count() == 0
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, secrets.made_findings(spark, 40).collect()))
    reviewed = made.withColumn("label", 1 - F.col("label"))  # the reviewer's word counts
    df = spark.createDataFrame([(1, f'api_key = "{"3f9a1c" * 6}"', "a")], "doc_id long, text string, source string")
    assert secrets.scan(df).first()["is_secret"] and not secrets.scan(df, reviewed=reviewed).first()["is_secret"]


def test_very_long_words(spark):
    """One word of a megabyte with thousands of tokens takes seconds."""
    import time
    rng = random.Random(1)
    word = ";".join("".join(rng.choice("0123456789abcdefgh") for _ in range(30)) for _ in range(33_000))
    df = spark.createDataFrame([(1, word, "a"), (2, "token=" + "a1" * 500_000, "a")], "doc_id long, text string, source string")
    began = time.time()
    found = secrets.scan(df).groupBy("doc_id").count().collect()
    assert dict(found) == {1: 33_000, 2: 1} and time.time() - began < 60


def test_leaks(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 10)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 8, 10, 11, 12, 15, 20, 33, 57, 90, 300])]
    docs, want = [], set()
    for i, text in items:
        for k in range(7):
            around = [word() for _ in range(rng.randrange(200))]
            at = rng.randrange(len(around) + 1)
            shown = text.upper().replace(" ", ", ") if k % 2 else text
            docs.append((len(docs), " ".join(around[:at]) + "\n" + shown + ".\n" + " ".join(around[at:])))
            want.add((docs[-1][0], i))
        docs.append((len(docs), " ".join(word() for _ in range(300))))
        changed = text.split()
        if len(changed) >= 57:  # one word in another place changes too little to hide it
            changed[len(changed) // 3] = "other"
            docs.append((len(docs), "before it " + " ".join(changed) + " after it"))
            want.add((docs[-1][0], i))
    benchmark = spark.createDataFrame(items + [(77, None), (None, "x"), (78, ""), (79, "Tiny one")], "item_id long, text string")
    edges = [(None, items[7][1]), (5000, None), (5001, ""), (5002, "tiny ONE!"), (5003, "a tiny one"), (5002, "tiny ONE!")]
    df = spark.createDataFrame([(*r, 1) for r in docs + edges], "doc_id long, text string, item_id int")
    found = decontaminate.find_leaks(df, benchmark).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id", "x.similarity")
    got = [(r["doc_id"], r["item_id"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([*want, (None, 7), (5002, 79), (5002, 79)], key=str)
    assert decontaminate.find_leaks(df, benchmark.limit(0)).where("size(leaks) > 0").count() == 0
    assert decontaminate.find_leaks(df.limit(0), benchmark).count() == 0
    in_blocks = decontaminate.find_leaks(df, benchmark, max_bytes=900)  # as many passes as the items need
    parts = decontaminate._blocks(benchmark.select(F.col("item_id").alias("i"), F.col("text").alias("t")), 900)
    assert len(parts) > 3 and sum(p.count() for p in parts) == benchmark.where("text is not null").count()
    whole = decontaminate.find_leaks(df, benchmark)
    assert sorted(map(str, in_blocks.collect())) == sorted(map(str, whole.collect()))


def best_of_all(text, item):
    """Similarity of the most similar region, over every region."""
    def bag(found, weight):
        out = Counter()
        for i in range(len(found) - 4):
            out[tuple(found[i:i + 5])] += int(weight[i:i + 5].sum())
        return out

    a, b = decontaminate.words(text), decontaminate.words(item)
    weight, mine = decontaminate.weights(a), bag(b, decontaminate.weights(b))
    best = 0.0
    for first in range(len(a) - 4):
        theirs, shared, total = Counter(), 0, 0
        for i in range(first, len(a) - 4):
            s, n = tuple(a[i:i + 5]), int(weight[i:i + 5].sum())
            shared += n if theirs[s] < mine[s] else 0
            theirs[s], total = theirs[s] + n, total + n
            best = max(best, shared / (sum(mine.values()) + total - shared))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_leaks_equal_every_region_of_edited_copies(seed):
    """Random runs of words inserted, deleted and replaced at random places; items that repeat themselves, too."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 10)))
    items = [[word() for _ in range(n)] for n in (7, 13, 40, 59, 100)] + [[word() for _ in range(20)] * 3]
    benchmark, texts = decontaminate.Benchmark([(i, " ".join(t)) for i, t in enumerate(items)], 80, 5), []
    for t in items:
        for _ in range(9):
            changed = list(t)
            for _ in range(rng.randrange(1, 4)):
                at, n = rng.randrange(len(changed)), rng.randrange(1, 2 + len(t) // 12)
                changed[at:at + rng.choice((0, 0, 1, n))] = [word() for _ in range(rng.choice((0, 1, n)))]
            texts.append(" ".join([word() for _ in range(9)] + changed + [word() for _ in range(9)]))
    near = 0
    for text, found in zip(texts, benchmark.leaks(texts), strict=True):
        got = {i: s for i, s, *_ in found}
        for i, item in enumerate(items):
            want = best_of_all(text, " ".join(item))
            near += 0.8 <= want < 1
            assert got.get(i, 0.0) == pytest.approx(want if want >= 0.8 else 0.0)
    assert near >= 10


@pytest.mark.parametrize(("length", "at", "n"), [(59, 30, 3), (100, 50, 8), (100, 80, 10)])
def test_leaks_with_an_inserted_run(length, at, n):
    item = [f"w{i:03d}" for i in range(length)]
    text = " ".join(item[:at] + [f"new{i}" for i in range(n)] + item[at:])
    found = decontaminate.Benchmark([(1, " ".join(item))], 80, 5).leaks([text])[0]
    assert [(i, a, m) for i, _, a, m in found] == [(1, 0, length + n)] and found[0][1] >= 0.8


def test_the_index_carries_the_result(monkeypatch):
    """Without its answers nothing is found."""
    item = [f"w{i:03d}" for i in range(60)]
    benchmark = decontaminate.Benchmark([(1, " ".join(item)), (2, "one two three four five six")], 80, 5)
    texts = [" ".join(["before", *item, "after"]), "and one two three four five six"]
    assert [[i for i, *_ in found] for found in benchmark.leaks(texts)] == [[1], [2]]
    none = np.zeros(0, np.int64)
    monkeypatch.setattr(decontaminate.Index, "within", lambda self, prints: (none, none))
    assert benchmark.leaks(texts) == [[], []]


@pytest.mark.parametrize("seed", range(3))
def test_an_unbroken_run_is_in_every_similar_region(seed):
    """Random edits, also where words weigh little: a region similar enough holds so many words of the item in a row."""
    rng = random.Random(seed)
    near = 0
    for _ in range(150):
        light = rng.random() < 0.5
        item = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 9] if light and i // 10 % 2 else [5, 9]))) + str(i)
                for i in range(rng.choice([6, 11, 20, 45, 60, 90]))]
        run = decontaminate.unbroken_run(decontaminate.weights([w.encode() for w in item]), 80)
        changed = list(item)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(changed))
            changed[at:at + rng.choice((0, 1, 1, 2))] = [f"new{rng.randrange(999)}" for _ in range(rng.choice((0, 1, 1)))]
        if best_of_all(" ".join(changed), " ".join(item)) >= 0.8:
            near += 1
            held = {tuple(changed[i:i + run]) for i in range(len(changed) - run + 1)}
            assert run >= 5 and any(tuple(item[i:i + run]) in held for i in range(len(item) - run + 1))
    assert near >= 20
    assert decontaminate.window_kind(5) == (1, 5) and decontaminate.window_kind(10) == (1, 8) and decontaminate.window_kind(63) == (4, 60)


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
    asked = prints[rng.integers(0, 200, 400)].copy()
    for _ in range(7):
        flip = rng.integers(0, 2, 400).astype(np.uint64)
        asked ^= flip << rng.integers(0, 64, 400).astype(np.uint64)
    index = decontaminate.Index(prints, np.arange(200), 5)
    got = set(zip(*(x.tolist() for x in index.within(asked))))
    near = np.bitwise_count(asked[:, None] ^ prints[None, :]) <= 5
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_pipeline_keeps_columns_and_clean_rows(spark, tmp_path):
    """Each stage on rows with a clashing extra column, NULLs and repeats; clean rows stay, planted ones go or change."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    clean = "Quiet sentences about rivers, boats and the long way home. They hold nothing that any rule would mind at all, nothing."
    extra = [(9001, clean), (9002, clean), (9002, clean), (9003, None), (9004, ""), (None, "Another " + clean)]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in extra], docs.schema)).withColumn("score", F.lit("mine"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns and docs.where("score = 'mine'").count() == docs.count()
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    left = sorted((r["doc_id"] if r["doc_id"] is not None else -1 for r in docs.where("doc_id is null or doc_id > 9000").collect()))
    assert left == [-1, 9001, 9003, 9004]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    assert not any(re.search(r'token = "[0-9a-f]{40}"', r["text"] or "") for r in docs.collect())


def test_empty_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break


def test_training_part(spark):
    import zlib
    rows = spark.range(50).select("id", in_training(F.col("id")).alias("t")).collect()
    assert all(r["t"] == (zlib.crc32(str(r["id"]).encode()) % 3 != 1) for r in rows)


def test_votes_equal_a_plain_sort():
    """Exact cosines with every labelled vector, the k greatest by a stable sort, weighted by similarity; also with ties."""
    rng = np.random.default_rng(3)
    for n, k in ((40, 7), (5, 15), (300, 15)):
        vectors = rng.normal(size=(n, 6)).astype(np.float32)
        vectors[1::4] = vectors[::4][:len(vectors[1::4])]  # equal neighbours
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        labels = rng.integers(0, 2, n).astype(np.float64)
        projection = rng.normal(size=(50, 6)).astype(np.float32)
        space = neighbours.Space(50, np.ones(50, np.float32), projection, vectors, labels, 0.25)
        rows = [(np.unique(rng.integers(0, 50, 9)), None) for _ in range(600)]
        rows = [(names, np.ones(len(names), np.float32)) for names, _ in rows] + [(np.zeros(0, np.int64), np.zeros(0, np.float32))]
        got = space.vote(rows, k)
        place = space.place(rows)
        for score, v in zip(got, place, strict=True):
            cosines = (v[None, :] @ vectors.T)[0]
            nearest = np.argsort(-cosines, kind="stable")[:min(k, n)]
            weight = np.maximum(cosines[nearest], 0).astype(np.float64)
            want = (weight * labels[nearest]).sum() / weight.sum() if weight.sum() > 1e-12 else 0.25
            assert score == pytest.approx(want, abs=1e-6)


def test_sample_holds_one_row_an_id(spark):
    """An id that repeats very often is one row of what the driver gets, the same one whatever the partitions."""
    from tallyframe.llm.labelled import labelled_sample, one_per_id
    docs = spark.range(5000).selectExpr("if(id < 4900, 7, id) as doc_id", "if(id % 3 = 0, null, concat('text ', id % 50)) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").distinct()
    sample = one_per_id(labelled_sample(docs, labels, "quality", 20), "doc_id", "text").collect()
    assert 20 < len(sample) <= 40 and all(r["text"] is not None for r in sample)
    again = one_per_id(labelled_sample(docs.repartition(7), labels, "quality", 20), "doc_id", "text").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sample))
    whole = one_per_id(labelled_sample(docs, labels, "quality", 5000), "doc_id", "text")
    assert whole.count() < 110 < labelled_sample(docs, labels, "quality", 5000).count()
    space = neighbours.train(docs, labels)
    assert len(space.labels) == whole.count()
