import random
import re

from fieldrank.llm import license_join as L

TEMPLATES = [("a", "alpha beta gamma delta"), ("b", "alpha omega"), ("m", "one two three four", "three"), ("c", "one two three four five six seven eight nine ten"), ("none", "...")]


def brute(text, templates, threshold):
    low = (text or "").translate(str.maketrans(L.UPPER, L.LOWER))
    w = [x for x in re.split(L.NOT_WORD, low) if x]
    places, base = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split(" ")
        at = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for block in re.split(L.BLOCK_BREAK, low):
        held = set(re.split(L.NOT_WORD, block))
        for label, t, *must in templates:
            tokens = set(re.split(L.NOT_WORD, t.lower())) - {""}
            if tokens and set(must) <= held and len(tokens & held) / len(tokens) >= threshold:
                labels.add(label)
                best = max(best, len(tokens & held) / len(tokens))
    return (len(w), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), 1.0 if places else best)


def check(spark, docs_of, texts, templates, threshold):
    rows = list(enumerate(texts))
    got = {r["row"]["doc_id"]: r for r in L.scan(docs_of(rows, "labels"), threshold=threshold, templates=templates).collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == brute(t, templates, threshold)[:6], t
        assert abs(r["score"] - brute(t, templates, threshold)[6]) < 1e-9


def test_edges(spark, docs_of):
    texts = [None, "", "...", "MIT  License mit-license", "under the GNU General\nPublic License; cc by-nc 4.0", "mitlicense xmit license", "é mit license é",
             "apache license apache license", "Licensed under CC BY-NC 4.0.", "word " * 60_000 + "mit license", L.TEMPLATES[0][1],
             "released under\n\nthe mit license", "Redistribution and use in source, binary forms with without modification are permitted provided following conditions met"]
    check(spark, docs_of, texts, L.TEMPLATES, L.THRESHOLD)


def test_no_licence_that_a_text_does_not_name(spark, docs_of):
    texts = {"licensed under CC BY 4.0": ["cc-by"], "GNU General Public License, version 2": ["gpl"],
             "Released under the Apache License": ["apache"], "was released under the old license by its owner": [],
             "Licensed under the BSD license, version 2.0 of the": [], "released under the MIT license": ["mit"],
             "Licensed under the Apache License, Version 2.0": ["apache", "apache-2.0"],
             "This work is licensed under the GNU General Public License, version 3": ["gpl", "gpl-3.0"], "Licensed under CC BY-NC 4.0": ["cc-by", "cc-by-nc-4.0"]}
    got = {r["row"]["doc_id"]: r["labels"] for r in L.scan(docs_of(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(texts.values()))


def test_join_equals_all_pairs(spark, docs_of):
    rng = random.Random(5)
    words = "alpha beta gamma delta omega one two three four five six seven eight nine ten other more".split()
    texts = ["\n \n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(0, 14))) for _ in range(rng.randrange(1, 4))) for _ in range(150)]
    for threshold in (0.5, 0.75, 1.0):
        check(spark, docs_of, texts, TEMPLATES, threshold)


def test_needed_is_exact():
    for size in range(1, 60):
        for t in (0.1, 0.5, 0.7, 0.8, 0.9, 1.0):
            assert L.needed(size, t) == min(k for k in range(1, size + 1) if k / size >= t)


def test_repeated_rows_and_empty(spark, docs_of):
    got = L.scan(docs_of([(1, "mit license"), (1, "mit license"), (None, "cc by")])).collect()
    assert len(got) == 3 and all(r["n_base"] == 1 for r in got)
    assert L.scan(docs_of([])).count() == 0
