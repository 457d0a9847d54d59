import numpy as np
from llm_rows import SF, TEXTS

from tierwise.llm import lm
from tierwise.llm.common import id_and_text
from tierwise.llm.decontaminate import word_hashes, words_of
from tierwise.llm.queries import op6_pseudo_likelihood


def places_of(line):
    places = np.flatnonzero(line != lm.WORDS)
    return places[np.argsort(line[places], kind="stable")]


def test_gradients():
    rng = np.random.default_rng(0)
    parameters = [p.astype(np.float64) for p in lm.start()]
    line = np.concatenate([[lm.WORDS] * 2, rng.integers(0, lm.WORDS, 40), [lm.WORDS] * 2])
    places = places_of(line)
    _, grads = lm.run_step(parameters, line, places, gradients=True)
    for p, g in zip(parameters, grads, strict=True):
        flat = p.ravel()
        for at in np.argsort(-np.abs(g.ravel()))[:5]:
            before = flat[at]
            values = []
            for step in (1e-5, -1e-5):
                flat[at] = before + step
                values.append(lm.run_step(parameters, line, places, gradients=False)[0].mean())
            flat[at] = before
            assert abs((values[0] - values[1]) / 2e-5 - g.ravel()[at]) < 1e-5


def test_probabilities_sum_to_one():
    parameters = lm.start()
    total = 0.0
    for word in range(lm.WORDS):
        line = np.array([5, 9, word, 3, lm.WORDS])
        total += np.exp(lm.run_step(parameters, line, np.array([2]), gradients=False)[0][0])
    assert abs(total - 1) < 1e-3


def test_words_are_counted_in_all_rows(docs, texts):
    counts = {r.word: r.n for r in lm.word_counts(id_and_text(docs).selectExpr("cast(text as binary) text")).collect()}
    expected = {}
    for text in texts.values():
        for word in word_hashes(words_of(text.encode())).view(np.int64).tolist():
            expected[word] = expected.get(word, 0) + 1
    assert counts == expected


def test_training_learns_and_scores_are_sums(docs, texts):
    rows = id_and_text(docs).selectExpr("cast(text as binary) text")
    top = sorted(lm.word_counts(rows).collect(), key=lambda r: (-r.n, r.word))[: lm.FREQUENT]
    frequent = np.array([r.word for r in top], dtype=np.int64).view(np.uint64)
    trained = lm.train(rows, frequent)
    ids = lm.WordIds(frequent)
    scored = {r.doc_id: r for r in lm.score(docs).collect()}
    better = 0
    for i, text in list(texts.items())[:60]:
        line, places, _ = ids.of([text.encode()])
        if len(places):
            own = sum(lm.run_step(trained, line, step_places, gradients=False)[0].sum() for step_places in (places[s] for s in lm.in_steps(line, places)))
            assert scored[i].n_words == len(places)
            assert abs(own - scored[i].log_likelihood) < 1e-3 * max(1, abs(own))
            better += own > lm.run_step(lm.start(), line, places_of(line), gradients=False)[0].sum()
    assert better > 55


def test_order_of_words_matters(docs, texts):
    scored = lm.score(docs).agg({"per_word": "avg"}).first()[0]
    assert scored > -np.log(lm.WORDS)


def test_odd_rows(odd_docs, no_docs):
    rows = lm.score(odd_docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    for r in rows:
        assert (r.per_word is None) == (r.n_words == 0) and (r.n_words or r.log_likelihood == 0)
    same = [r for r in rows if r.doc_id in (1, 8)]
    assert len({round(r.log_likelihood, 3) for r in same}) == 1
    assert lm.score(no_docs).count() == 0


def test_query(spark, texts):
    assert op6_pseudo_likelihood(spark, SF).count() == len(texts)


def test_every_word_is_predicted_inside_its_group(spark):
    base = [f"base{i}" for i in range(lm.FREQUENT)]
    group = int(word_hashes([b"rare"])[0]) % (lm.WORDS - lm.FREQUENT)
    gibberish = next(w for w in (f"q{i}" for i in range(10_000)) if int(word_hashes([w.encode()])[0]) % (lm.WORDS - lm.FREQUENT) == group)
    given = [(1, "base0 base1 rare base2"), (2, f"base0 base1 {gibberish} base2"), (3, "rare rare rare"), (4, " ".join(base * 20)), (4, "rare rare rare"), (5, "")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    rows = lm.score(docs).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4, 4, 5]
    one, two, three, empty = (next(r for r in rows if r.doc_id == i) for i in (1, 2, 3, 5))
    assert abs(one.log_likelihood - two.log_likelihood) < 1e-3
    assert abs(one.token_log_likelihood - two.token_log_likelihood - np.log(7)) < 1e-3
    assert abs(three.token_log_likelihood - three.log_likelihood - 3 * np.log(7 / 8)) < 1e-6
    assert three.per_token == three.token_log_likelihood / 3
    assert (empty.token_log_likelihood, empty.per_token) == (0, None)


def test_shares_of_all_words(docs, texts):
    words = {i: word_hashes(words_of(t.encode())).tolist() for i, t in texts.items()}
    counts = {}
    for w in (w for own in words.values() for w in own):
        counts[w] = counts.get(w, 0) + 1
    rare = {w: n for w, n in sorted(counts.items(), key=lambda c: (-c[1], np.uint64(c[0]).view(np.int64)))[lm.FREQUENT :]}
    groups = lm.WORDS - lm.FREQUENT
    total = np.zeros(groups)
    for w, n in rare.items():
        total[w % groups] += n
    for r in lm.score(docs).collect():
        expected = sum(np.log(rare[w] / total[w % groups]) for w in words[r.doc_id] if w in rare)
        assert abs(r.token_log_likelihood - r.log_likelihood - expected) < 1e-6 * max(1, -expected)


def plain_network(texts):
    """The whole computation for texts of one task and one step, place by place in double precision: words by their
    counts, one Adagrad step of the mean gradient, then each text's sums."""
    hashes = [[int(h) for h in word_hashes(words_of(t.encode()))] for t in texts]
    counts = {}
    for h in (h for own in hashes for h in own):
        counts[h] = counts.get(h, 0) + 1
    signed = {h: h - (1 << 64) if h >> 63 else h for h in counts}
    most = sorted(counts, key=lambda h: (-counts[h], signed[h]))[: lm.FREQUENT]
    number = {h: i for i, h in enumerate(most)}
    groups = lm.WORDS - len(most)

    def word(h):
        return number[h] if h in number else len(most) + h % groups

    embedding, shift, to_class, class_shift, to_word, word_shift = parameters = [p.astype(np.float64) for p in lm.start()]

    def places():
        for n, own in enumerate(hashes):
            line = [lm.WORDS] * 2 + [word(h) for h in own] + [lm.WORDS] * 2
            for i in range(2, len(line) - 2):
                yield n, line[i], [line[i + side] for side in lm.SIDES]

    def outputs(around):
        hidden = np.tanh(sum(embedding[side][w] for side, w in enumerate(around)) + shift)
        at_class = np.exp(hidden @ to_class + class_shift)
        return hidden, at_class / at_class.sum()

    def in_class(hidden, c):
        at = np.exp(hidden @ to_word[c] + word_shift[c])
        return at / at.sum()

    total, n_words = [np.zeros_like(p) for p in parameters], 0
    for _, w, around in places():
        c, inner = divmod(w, lm.IN_CLASS)
        hidden, p_class = outputs(around)
        p_word = in_class(hidden, c)
        d_class, d_word = -p_class, -p_word
        d_class[c] += 1
        d_word[inner] += 1
        back = (to_class @ d_class + to_word[c] @ d_word) * (1 - hidden**2)
        for side, v in enumerate(around):
            total[0][side, v] += back
        for at, g in ((1, back), (2, np.outer(hidden, d_class)), (3, d_class)):
            total[at] += g
        total[4][c] += np.outer(hidden, d_word)
        total[5][c] += d_word
        n_words += 1
    for p, g in zip(parameters, total, strict=True):
        g /= n_words
        p += lm.RATE * g / np.sqrt(1e-8 + g * g)
    tail = {}
    for h in counts:
        if h not in number:
            tail[word(h)] = tail.get(word(h), 0) + counts[h]
    sums = np.zeros(len(texts))
    for n, w, around in places():
        hidden, p_class = outputs(around)
        sums[n] += np.log(p_class[w // lm.IN_CLASS]) + np.log(in_class(hidden, w // lm.IN_CLASS)[w % lm.IN_CLASS])
    shares = [sum(np.log(counts[h] / tail[word(h)]) for h in own if h not in number) for own in hashes]
    return sums, sums + np.array(shares), [len(own) for own in hashes]


def test_whole_result_against_a_plain_version(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(900)]
    weights = 1 / np.arange(1, 901)
    texts = [" ".join(rng.choice(words, size=n, p=weights / weights.sum())) for n in rng.integers(0, 90, 60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    network, tokens, lengths = plain_network(texts)
    rows = sorted(lm.score(docs).collect(), key=lambda r: r.doc_id)
    assert [r.n_words for r in rows] == lengths and sum(lengths) < lm.STEP and len({w for t in texts for w in t.split()}) > lm.FREQUENT
    # gradients near zero lose their sign in single precision, and Adagrad's first step is their sign
    assert np.allclose([r.log_likelihood for r in rows], network, rtol=2e-3, atol=1e-2)
    assert np.allclose([r.token_log_likelihood for r in rows], tokens, rtol=2e-3, atol=1e-2)
