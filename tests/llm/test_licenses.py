import re

from logweave.llm import licenses as L
from pyspark.sql import functions as F

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    """n_words, places and labels of the base phrases, by list comparison."""
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(text)
    places = []
    for phrase, label in L.PHRASES:
        p = phrase.split()
        places += [(label, i) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(places, key=lambda x: (x[1], x[0]))


def brute_match(words, template, anchors, weights):
    """Whether any placement of the template has enough anchors near their places and its phrases in place."""
    notice = template.notice.split()
    total = sum(weights[w] for w in notice if w in anchors)
    for offset in range(-len(notice), len(words)):
        share = sum(weights[w] for t, w in enumerate(notice) if w in anchors and any(
            0 <= p < len(words) and words[p] == w for p in range(offset + t, offset + t + L.DRIFT + 1))) / total
        def stands(phrase):
            p = phrase.split()
            t = next(i for i in range(len(notice)) if notice[i:i + len(p)] == p)
            return any(q >= 0 and words[q:q + len(p)] == p for q in range(offset + t - L.DRIFT, offset + t + L.DRIFT + 1))
        if share >= L.SHARE + 1e-9 and all(map(stands, template.phrases)):
            return True
    return False


def with_texts(spark, docs, texts):
    rows = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs.select("doc_id", "text", "score", "label").unionByName(rows.selectExpr("*", "double(1) AS score", "'y' AS label"))


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
       "publish, distribute, sublicense, and/or sell copies of the Software")
TEXTS = [MIT, "x " * 500 + MIT + " y" * 500, MIT.replace(" any ", " any other natural "), "apache license " * 300, "Apache-License; MIT License! cc_by cc-by-nc",
         "Licensed under CC BY-SA 4.0", "ççcc by", "cc byé", "permission is hereby granted", "GNU Lesser General Public License", None, "",
         "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
         "This is free and unencumbered software released into the public domain.", "license version under the licensed apache 0 2", "\x00MIT\x7fLicense\x80"]


def test_base_against_brute_force(spark, docs):
    rows = with_texts(spark, docs, TEXTS)
    index = L.build_index(rows.select("text"))
    got = L.scan_licenses(rows, index, keep=["doc_id", "text", "label"]).collect()
    assert len(got) == rows.count()
    for r in got:
        assert (r.n_words, [(p.label, p.start) for p in r.places]) == brute(r.text)
        assert 0 <= r.score <= 1 and (not r.places or r.score >= 0.5)


def test_matches_against_brute_force(spark, docs):
    rows = with_texts(spark, docs, TEXTS)
    texts = [r.text for r in rows.collect()]
    index = L.build_index(rows.select("text"))
    folded = [[w.decode("utf-8", "replace") for w in L.words_of((t or "").encode())] for t in texts]
    for r in L.scan_licenses(rows, index, keep=["text"]).collect():
        words = [w.decode("utf-8", "replace") for w in L.words_of((r.text or "").encode())]
        expected = set()
        for number, template in enumerate(L.TEMPLATES):
            notice = template.notice.split()
            df = {w: sum(w in f for f in folded) for w in notice}
            weights = {w: L.math.log((len(folded) + 2) / (df[w] + 1)) for w in notice}
            anchors = set(sorted(weights, key=lambda w: (-weights[w], w))[:L.ANCHORS])
            assert {w.decode() for w, p in index.postings.items() if any(x[0] == number for x in p)} == anchors
            if len(words) < 3000 and brute_match(words, template, anchors, weights):
                expected.add(template.label)
        if len(words) < 3000:
            assert {m.label for m in r.matches} == expected, (r.text or "")[:80]


def test_notices_get_their_labels(spark, docs):
    rows = with_texts(spark, docs, TEXTS)
    got = {r.doc_id: r for r in L.scan_licenses(rows, L.build_index(rows.select("text"))).collect()}
    labels = lambda i: {m.label for m in got[5000 + i].matches}
    assert labels(0) == labels(1) == labels(2) == {"mit"} and got[5001].matches[0].start == 500
    assert labels(5) >= {"cc-by-sa"} and labels(12) == {"bsd"} and labels(13) == {"unlicense"}
    assert not labels(8) and not labels(9) and not labels(14)
    assert got[5000].score == 1.0 and got[5011].score == 0.0 and got[5010].n_words == 0


def test_empty_table(spark, empty):
    index = L.build_index(empty.select("text"))
    assert L.scan_licenses(empty, index).collect() == []


def test_query(spark):
    from logweave.llm.common import table
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in L.op11_licenses(spark, sf).collect()}
    for d in table(spark, sf, "documents").select("doc_id", F.col("text")).collect():
        n, places = brute(d.text)
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), places[0][1] if places else None, places[-1][1] if places else None)
        assert r.base_labels == ",".join(sorted({p[0] for p in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and r.labels == ",".join(sorted(set(r.labels.split(","))))
    # held against the planted licence lines: nothing else is labelled
    assert {d for d, r in got.items() if r.labels} == {d for d, r in got.items() if r.base_labels}
