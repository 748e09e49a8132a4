"""Trained models: gradients, plain versions of their inference, and accuracy on documents they have not seen."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from daymark import session
from daymark.llm import languages, quality, toxicity, vectors

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


# --- languages -------------------------------------------------------------------------------------------------------


def small_net(dtype=np.float64):
    net = languages.initial(3, languages.Training(hidden=4), dtype)
    return {k: v.astype(dtype) for k, v in net.items()}


def plain_positions(word, net):
    """One word, one byte at a time."""

    def states(data, x, u):
        size, h, out = u.shape[0], np.zeros(u.shape[0]), []
        for byte in data:
            a, b = x[byte], h @ u
            z = 1 / (1 + np.exp(-(a[:size] + b[:size])))
            r = 1 / (1 + np.exp(-(a[size : 2 * size] + b[size : 2 * size])))
            new = np.tanh(a[2 * size :] + r * b[2 * size :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    ahead = states(word, net["forward_x"], net["forward_u"])
    back = states(word[::-1], net["back_x"], net["back_u"])[::-1]
    logits = np.array(ahead) @ net["forward_o"] + np.array(back) @ net["back_o"] + net["bias"]
    return np.exp(logits) / np.exp(logits).sum(1, keepdims=True)


def test_positions_are_those_of_one_word_at_a_time():
    net, words = small_net(), [b"abc", "größe".encode(), b"x", b"longerword"]
    rows, lengths, order = languages.padded(words)
    found = languages.positions(rows, lengths, net)
    for row, i in enumerate(order):
        assert np.allclose(found[row, : lengths[row]], plain_positions(words[i], net))
        assert not found[row, lengths[row] :].any()


def test_gradients_are_those_of_the_loss():
    net = small_net()
    rows, lengths, _ = languages.padded([b"abc", b"ab", b"dddde", b"c"])
    wanted, weight = np.array([0, 2, 1, 2]), np.array([1.0, 0.5, 2.0, 1.5])
    _, slopes = languages.gradients(rows, lengths, wanted, weight, net)
    rng = np.random.default_rng(0)
    for name, value in net.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if name.endswith("_x"):
                at = (int(rng.choice(list(b"abcde"))), at[1])
            losses = []
            for move in (1e-5, -1e-5):
                value[at] += move
                losses.append(languages.gradients(rows, lengths, wanted, weight, net)[0])
                value[at] -= move
            assert np.isclose(slopes[name][at], (losses[0] - losses[1]) / 2e-5, rtol=1e-4, atol=1e-7), name


def test_languages_of_documents_not_learnt_from(docs):
    model = languages.fit(docs)
    rows = languages.predicted(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    unseen = [row for row in rows if row["held_out"]]
    assert len(unseen) > 250 and model.languages == sorted({row["lang"] for row in rows})
    assert sum(row["lang"] == row["lang_pred"] for row in unseen) / len(unseen) > 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)
    for row in rows[:15]:  # the document's score is the mean over all positions
        pieces = [p for word in row["text"].encode().split() for p in languages.pieces(word, model.longest)]
        pooled = np.concatenate([plain_positions(p, model.net) for p in pieces]).mean(0)
        assert model.languages[int(pooled.argmax())] == row["lang_pred"] and abs(pooled.max() - row["score"]) < 1e-4


def test_texts_without_letters():
    model = languages.Model(["a", "b"], small_net() | {"forward_o": np.zeros((4, 2)), "back_o": np.zeros((4, 2)), "bias": np.zeros(2)}, 8)
    found = list(languages.Reader(model)([None, b"", b"12 !? \xc2\xb2", "é".encode(), b"x" * 100, "名前".encode()]))
    assert [name for name, _ in found] == ["und", "und", "und", "a", "a", "a"]
    assert found[0][1] == 0 and found[3][1] == 0.5


def test_rare_and_unspaced_languages_are_learnt(spark):
    """Two languages have more frequent words than the bound; a rare one and one without spaces have few or unique ones."""
    rng = np.random.default_rng(8)

    def word(letters):
        return "".join(rng.choice(list(letters), 6))

    latin, greek = [word("abcdefghij") for _ in range(400)], [word("αβγδεζηθικ") for _ in range(400)]
    rows = []
    for _ in range(60):
        rows.append(("aa", " ".join(rng.choice(latin, 100))))
        rows.append(("bb", " ".join(rng.choice(greek, 100))))
        rows.append(("zz", "".join(rng.choice(list("日本語文字列東京都"), 120))))
    rows += [("rr", " ".join(word("бвгджзклмн") for _ in range(8))) for _ in range(12)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id bigint, lang string, text string")
    model = languages.fit(df, languages.Training(words=300, batch=32, epochs=20))
    found = languages.predicted(df, model).join(df, "doc_id").collect()
    for lang in ("aa", "bb", "rr", "zz"):
        unseen = [row["lang_pred"] == lang for row in found if row["lang"] == lang and row["held_out"]]
        assert unseen and sum(unseen) / len(unseen) > 0.9, lang


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_ordinal_fit_recovers_ordered_grades():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    score = x @ np.array([2, -1, 0, 0, 1.5, 0])
    noise = rng.logistic(size=3000)
    grades = np.searchsorted([-1.0, 1.5], score + noise)
    weights, thresholds = toxicity.fit_ordinal(x, grades, toxicity.Training(steps=1500), 1e-4)
    assert np.allclose(weights, [2, -1, 0, 0, 1.5, 0], atol=0.25) and np.allclose(thresholds, [-1, 1.5], atol=0.25)
    sparse, _ = toxicity.fit_ordinal(x, grades, toxicity.Training(), 0.05)
    assert (sparse[[2, 3, 5]] == 0).all() and (sparse[[0, 1, 4]] != 0).all()


def test_toxicity_of_labelled_documents(docs, labels):
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs, model).join(labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert (np.diff(model.thresholds) > 0).all()
    for row in rows:
        assert 0 <= row["severity"] <= len(model.thresholds)
        assert row["toxic"] == (row["grade"] > 0) == (row["p_toxic"] >= 0.5)
    for label, wanted in ((1, True), (0, False)):
        right = [row["toxic"] == wanted for row in rows if row["label"] == label]
        assert sum(right) / len(right) > 0.95


def test_toxicity_of_documents_not_learnt_from(docs, labels):
    """Fitted to half of the labels, tried on the other half."""
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    other = labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label")
    rows = toxicity.scored(docs, model).join(other, "doc_id").collect()
    right = sum(row["toxic"] == (row["label"] == 1) for row in rows)
    assert right / len(rows) > 0.9


def test_severity_is_the_expected_grade():
    model = toxicity.Model({"bad": 2.0, "awfu-": 1.0}, np.array([1.0, 3.0]))
    features = toxicity._known(model)
    above = toxicity.severity(b"Bad, bad! AWFUL day", model, features)
    score = 2 * np.log(3) + np.log(2)
    assert np.allclose(above, 1 / (1 + np.exp(np.array([1.0, 3.0]) - score)))
    assert toxicity.severity(b"  ", model, features).sum() == 0


# --- quality ---------------------------------------------------------------------------------------------------------


def plain_counts(text):
    words = [word.decode() for word in (text or "").encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, seen, dups = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dups, len(covered)


def test_base_counts():
    rng = np.random.default_rng(2)
    letters = ["a", "b", " ", "\n", "é", "ß", "\U0001f600", "#", "|", "\t", " ", "\x1c", "A", "9", "!"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 80))) for _ in range(400)] + [None, "", "\n\n", "a\na\n a\na"]
    for text in texts:
        found = quality.read(None if text is None else text.encode())
        assert tuple(found[:5]) == plain_counts(text), text
        assert found.line_words.sum() == found.words


def random_field(rng):
    return quality.Field(rng.normal(size=(len(quality._STEPS), quality._WIDTH, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def random_documents(rng):
    sizes = rng.integers(1, 7, 12)
    width = [len(s) + 1 for s in quality._STEPS.values()]
    return [
        quality.Document(0, 0, 0, 0, 0, np.ones(n, int), np.stack([rng.integers(0, w, n) for w in width], 1).astype(np.int8))
        for n in sizes
    ]


def path_score(document, field, states):
    emission = field.emission[np.arange(len(quality._STEPS)), document.features].sum(1)
    moves = sum(field.transition[a, b] for a, b in zip(states, states[1:]))
    return field.start[states[0]] + moves + sum(emission[i, s] for i, s in enumerate(states))


def test_best_labelling_and_likelihood_are_those_of_all_labellings():
    rng = np.random.default_rng(3)
    field, documents = random_field(rng), random_documents(rng)
    scores, lengths, order = quality.stacked(documents, field)
    states = quality.viterbi(scores, lengths, field)
    given = rng.integers(0, 2, states.shape).astype(np.int8)
    value, *_ = quality.likelihood(scores, lengths, given, field)
    wanted = 0.0
    for row, i in enumerate(order):
        n = lengths[row]
        every = {path: path_score(documents[i], field, path) for path in itertools.product((0, 1), repeat=int(n))}
        assert tuple(states[row, :n]) == max(every, key=every.get)
        total = np.log(sum(np.exp(s) for s in every.values()))
        wanted += every[tuple(int(s) for s in given[row, :n])] - total
    assert np.isclose(value, wanted)


def test_field_gradients():
    rng = np.random.default_rng(4)
    field, documents = random_field(rng), random_documents(rng)

    def value():
        scores, lengths, _ = quality.stacked(documents, field)
        return quality.likelihood(scores, lengths, given, field)

    scores, lengths, _ = quality.stacked(documents, field)
    given = rng.integers(0, 2, scores.shape[:2])
    _, lines, moves, starts = value()
    for array, slope in ((field.transition, moves), (field.start, starts)):
        for at in np.ndindex(array.shape):
            array[at] += 1e-5
            up = value()[0]
            array[at] -= 2e-5
            down = value()[0]
            array[at] += 1e-5
            assert np.isclose(slope[at], (up - down) / 2e-5, rtol=1e-4, atol=1e-6)
    assert np.allclose(lines.sum(2), 0)


def test_quality_of_documents_not_learnt_from(docs, labels):
    field = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.judged(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [row["kept"] for row in rows if row["quality"] == 1 and not row["base_failed"]]
    poor = [row["kept"] for row in rows if row["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(poor) / len(poor) < 0.15
    for row in rows:
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert row["kept"] == (not row["base_failed"] and row["content_share"] >= 0.5)


def test_a_long_document_does_not_end_the_fit(spark):
    """The first document in the order of the fit has more lines than all may give together."""
    order = quality.seeded_order(quality.F.col("id"), quality.Training().seed)
    ids = [row["id"] for row in spark.range(40).orderBy(order, "id").collect()]
    good, poor = "The quiet river ran along the old stone wall of the town.", "HOME | LOGIN | 123 | # MENU"
    docs = [(i, "\n".join([poor if n % 2 else good] * (900 if n == 0 else 6))) for n, i in enumerate(ids)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - n % 2) for n, i in enumerate(ids)], "doc_id bigint, quality int")
    field = quality.fit(df, labels, quality.Training(lines=400))
    words = quality.content_words([quality.read(x.encode()) for x in (good, poor)], field)
    assert words == [12, 0]


def test_lines_that_documents_may_give():
    assert quality.quota({6: 39, 900: 1}, 400) == 166 and quality.quota({6: 39, 900: 1}, 2000) == 900
    assert quality.quota({5: 10}, 3) == 1 and quality.quota({}, 3) == 1
    rows = np.arange(900)[:, None]
    assert len(quality.evenly_spaced(rows, 166)) == 166 and quality.evenly_spaced(rows, 900) is rows
    assert (np.diff(quality.evenly_spaced(rows, 166)[:, 0]) >= 5).all()


# --- vectors ---------------------------------------------------------------------------------------------------------


def plain_links(rows, threshold):
    links = {}
    for (i, label, x), (j, other, y) in itertools.combinations(rows, 2):
        if label is None or label != other or x is None or y is None or len(x) != len(y):
            continue
        a, b = np.array(x, float), np.array(y, float)
        norm = np.linalg.norm(a) * np.linalg.norm(b)
        if norm and np.isfinite(norm) and a @ b / norm >= threshold:
            links.setdefault(i, set()).add(j)
            links.setdefault(j, set()).add(i)
    return links


def reachable(links, i):
    seen, todo = {i}, [i]
    while todo:
        for j in links.get(todo.pop(), ()):
            if j not in seen:
                seen.add(j)
                todo.append(j)
    return min(seen)


@pytest.mark.parametrize("how", [vectors.Search(), vectors.Search(sample=100, cell_rows=5, block=4)])
def test_links_are_those_of_all_pairs(spark, how):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(400):
        x = centres[rng.integers(0, 12)] + rng.normal(size=16) * rng.choice([0, 0.03, 0.1, 0.2, 1.0])
        rows.append((i, [None, 1, 2, 3][rng.choice(4, p=[0.1, 0.6, 0.2, 0.1])], (x * rng.choice([1, 5])).tolist()))
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, rows[0][2], rows[0][2][:7], [-0.0, 1.0]]
    rows += [(400 + i, 1, x) for i, x in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    links = plain_links([r for r in rows if r[2] and None not in r[2]], 0.98)
    for row in vectors.near_duplicates(df, how).collect():
        wanted = reachable(links, row["vec_id"])
        assert (row["n_links"], row["component_id"]) == (len(links.get(row["vec_id"], ())), wanted)
        assert row["kept"] == (row["vec_id"] == wanted)


def test_loose_links_beside_a_tight_group(spark):
    """Nearly all pairs are those of one tight group; the links of the others lie near the threshold, in few directions."""
    rng = np.random.default_rng(9)
    rows = [np.eye(64)[0] + rng.normal(size=64) * 1e-5 for _ in range(2500)]
    for _ in range(150):
        x, y = np.zeros((2, 64))
        x[[0, 1, 32, 33]], y[[0, 1, 32, 33]] = rng.normal(size=(2, 4))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        rows += [x, 0.981 * x + (1 - 0.981**2) ** 0.5 * y / np.linalg.norm(y)]
    rows = [(i, 1, x.tolist()) for i, x in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    x = np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    wanted = (x @ x.T >= 0.98).sum(1) - 1
    found = vectors.near_duplicates(df, vectors.Search(cell_rows=10)).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(wanted.tolist()))


def test_vectors_are_stored_once(spark, tmp_path, monkeypatch):
    """Vectors without structure visit most cells, and neither they nor the lists of their cells are stored for it."""
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    rng = np.random.default_rng(10)
    rows = [(i, i % 2, x.tolist()) for i, x in enumerate(rng.normal(size=(1200, 32)))]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    found = vectors.near_duplicates(df, vectors.Search(cell_rows=2)).collect()
    assert len(found) == 1200 and not any(r["n_links"] for r in found)
    stored = sum(path.stat().st_size for path in tmp_path.rglob("*.parquet"))
    assert 0 < stored < 2 * 1200 * 32 * 4


def test_spans_meet_in_rounds(spark, monkeypatch):
    """Labels over many spans, whose pairs are dealt to several rounds; single precision, odd values, repeated rows."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(400):
        x = centres[rng.integers(0, 6)] + rng.normal(size=12) * rng.choice([0, 1e-4, 0.03, 0.15, 1.0])
        rows.append((i, [1, 2, 3][rng.choice(3, p=[0.8, 0.15, 0.05])], (x * rng.choice([1, 5])).astype(np.float32).tolist()))
    odd = [None, [], [0.0] * 12, [1.0, None], [float("nan")] * 12, rows[0][2][:5], [-0.0, 1.0], [0.0, 2.0], [3e38] * 12]
    rows += [(400 + i, 1, x) for i, x in enumerate(odd)]
    purposes = []
    monkeypatch.setattr(vectors, "LEAST_SHIPPED", 1)
    monkeypatch.setattr(vectors, "fresh_folder", lambda s, purpose: purposes.append(purpose) or session.fresh_folder(s, purpose))
    df = spark.createDataFrame([*rows, *rows[:50]], "vec_id bigint, label int, embedding array<float>")
    how = vectors.Search(sample=100, cell_rows=5, block=4, held=1500, shipped=2.0)
    before = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    found = vectors.near_duplicates(df, how).collect()
    assert purposes.count("links") > 2
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == before
    links = plain_links([r for r in rows if r[2] and None not in r[2]], 0.98)
    assert len(found) == len(rows) + 50 and {r["vec_id"] for r in found} == {r[0] for r in rows}
    for row in found:
        wanted = reachable(links, row["vec_id"])
        assert (row["n_links"], row["component_id"]) == (len(links.get(row["vec_id"], ())), wanted)
        assert row["kept"] == (row["vec_id"] == wanted)


def test_groups_are_united():
    rng = np.random.default_rng(12)
    a, b = rng.integers(0, 300, (2, 200))
    root = np.arange(300)
    for part in range(0, 200, 50):
        vectors.unite(root, a[part : part + 50], b[part : part + 50])
    links = {}
    for i, j in zip(a.tolist(), b.tolist()):
        links.setdefault(i, set()).add(j)
        links.setdefault(j, set()).add(i)
    assert root.tolist() == [reachable(links, i) for i in range(300)]


def test_vectors_without_ids_repeated_and_none(spark):
    schema = "vec_id bigint, label int, embedding array<float>, n int, cell string, size int"
    rows = [(1, 1, [1.0, 2.0], 0, "", 1), (1, 1, [1.0, 2.0], 0, "", 1), (None, 1, [1.0, 2.0], 0, "", 1), (2, 1, [2.0, 4.0], 0, "", 1)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    by_id = {row["vec_id"]: row for row in found}
    assert len(found) == 4 and by_id[1]["n_links"] == by_id[2]["n_links"] == 1
    assert by_id[2]["component_id"] == 1 and by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_cells_come_in_order_of_distance():
    rng = np.random.default_rng(6)
    first, second = rng.random(9), rng.random(7)
    cells = list(vectors.nearest_cells(first, second, 0.8))
    sums = [first[i] + second[j] for i, j in cells]
    assert sums == sorted(sums)
    assert set(cells) == {(i, j) for i in range(9) for j in range(7) if first[i] + second[j] <= 0.8}


def test_bounds_hold():
    rng = np.random.default_rng(7)
    points, centroids = rng.normal(size=(300, 5)), rng.normal(size=(8, 5))
    nearest, least = vectors.bounds(points, centroids)
    apart = ((points[:, None] - points[None]) ** 2).sum(2)
    assert (apart >= least[:, nearest] - 1e-9).all()
