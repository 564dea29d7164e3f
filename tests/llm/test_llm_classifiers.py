"""Language, toxicity and licences: rules and held-out accuracy."""

import random

import numpy as np
import pytest
from helpers import DOCS, corpus, frame, prose
from pyspark.sql import functions as F

from casefeatures.llm import language, license, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").toPandas()
    assert len(out) > 100 and (out["lang"] == out["lang_pred"]).mean() > 0.97
    assert out["score"].between(0, 1).all()


def test_language_rows(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "12 !?", "de", "a", 0), (4, "the cat and the dog", "en", "a", 0), (4, "the cat and the dog", "en", "a", 0), (None, "der Hund und die Katze", "de", "a", 0)]
    rows += [(i, "the cat sat on the mat with that thing", "en", "a", 0) for i in range(10, 20)] + [(i, "der Hund und die Katze schlafen nicht", "de", "a", 0) for i in range(20, 30)]
    rows += [(40, "漢字", None, "a", 0), (41, "Katze " * 300_000, None, "a", 0)]
    df = frame(spark, rows).withColumns({"_lang": F.lit("x"), "_score": F.lit(5)})
    out = {r["doc_id"]: r for r in language.predicted(df).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3, 4, None, 41)] == ["und", "und", "und", "en", "de", "de"]
    assert out[40]["lang_pred"] in ("de", "en") and out[40]["score"] == 0.0 and out[None]["held_out"]
    kept = language.kept(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {4, None, 41} and kept.where("doc_id in (1, 2, 3, 40)").count() == 0
    assert language.predicted(spark.createDataFrame([], DOCS)).collect() == []
    nothing = language.predicted(frame(spark, [(4, "some text", None, "a", 0)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in nothing] == [("und", 0.0)]


def test_grams_do_not_depend_on_pieces(monkeypatch):
    letters = language._letters()
    text = "Ärger über 12 Öfen, naïve café. " * 20
    whole = np.sort(np.concatenate(list(language._grams(text, letters))))
    monkeypatch.setattr(language, "PIECE", 7)
    assert (np.sort(np.concatenate(list(language._grams(text, letters)))) == whole).all()


def test_filters_of_many_languages(spark):
    """More languages than a word has bits, and masks that name several at once."""
    rng = random.Random(1)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 4)) for _ in range(70)]
    rows = [(i, " ".join("".join(rng.choice(alphabets[i % 70]) for _ in range(6)) for _ in range(40)), f"l{i % 70:02}", "a", 0) for i in range(700)]
    filters = language.learned(frame(spark, rows))
    assert len(filters.languages) == 70 and filters.slots.shape[1] == 2
    out = language.identified(frame(spark, rows).select("lang", "text"), filters)
    assert out.where("lang = _lang").count() > 650


def test_grammar():
    stems, lengths = dict.fromkeys(toxicity.INSULTS, 4.0), tuple(sorted({len(s) for s in toxicity.INSULTS}))
    plain = toxicity.clause_score("an idiot wrote it down", stems, lengths)
    named = toxicity.clause_score("you are an idiot", stems, lengths)
    denied = toxicity.clause_score("you are not an idiot", stems, lengths)
    quoted = toxicity.clause_score("he said you are an idiot", stems, lengths)
    assert named > denied > 0 and named > quoted > 0 and plain > 0
    assert toxicity.clause_score("i will kill you", stems, lengths) > 0 and toxicity.clause_score("a quiet day", stems, lengths) == 0


def _best(text):
    stems = dict.fromkeys(toxicity.INSULTS, 4.0)
    return toxicity.features(text, stems, toxicity._automaton(stems), tuple(sorted({len(s) for s in stems})))[0]


def test_threats():
    plain = _best("I will hurt you")
    assert _best("I would never hurt you") == plain * toxicity.DENIED and _best("He said I will hurt you") == plain * toxicity.QUOTED
    assert _best("I will  Hurt   you, idiot") > plain and _best("i will make you pay.") == plain
    assert [_best(t) for t in ("we beat your price", "a skill you need", "make you payments", "if looks could kill, you know")] == [0.0] * 4


def test_threats_are_composed_of_intent_act_and_target():
    plain = _best("I will hurt you")
    for text in ("i will murder you", "i will kill him", "we will hurt your family", "we'll destroy them", "ich werde dich töten", "i am going to stab you", "kill yourself"):
        assert _best(text) == plain, text
    assert _best("i will not kill him") == _best("we’ll never crush them") == plain * toxicity.DENIED
    for text in ("the frost will kill them", "he will hurt, them too", "we will see what they shoot", "i will tell you how to kill weeds", "you pay", "we will, he said"):
        assert _best(text) == 0.0, text


def test_listed_insults_are_words():
    assert _best("clownfish are pretty") == _best("trashcan lids") == 0.0
    assert _best("stupidity") == _best("clowns") == _best("clown's") == _best("stupid") > 0


def test_composed_machine_is_its_machines_together():
    """Every arc and end of the composition weighs what the five machines weigh that read the same classes one beside the other."""
    rng = random.Random(5)
    for _ in range(300):
        symbols = [rng.choice(toxicity._SYMBOLS) for _ in range(rng.randrange(1, 12))]
        threat, left, state, total, want = ("start", 0), 0, 0, 0.0, 0.0
        for symbol in symbols:
            state, arc = toxicity._GRAMMAR.arcs[state][symbol]
            total += arc
            threat, found = toxicity._threat(threat, symbol)
            left, factor = toxicity._denied(left, symbol)
            want += (found + (symbol == "insult")) * factor
        named = toxicity.NAMED if {"you", "others", "subject"} & set(symbols) else 1.0
        want *= named * (toxicity.QUOTED if "report" in symbols else 1.0)
        assert total * toxicity._GRAMMAR.final[state] == pytest.approx(want), symbols


def test_reported_speech():
    plain = _best("you are an idiot")
    for text in ("he said: you are an idiot", "\"You are an idiot\", he said", "You are an idiot, she wrote", "He said, “Go home! You are an idiot.”", "\"You are an idiot!\" he said.", "he said: i will kill you"):
        assert _best(text) == plain * toxicity.QUOTED, text
    for text in ("he said so. you are an idiot", "\"fine\" he said.\nyou are an idiot", "note: you are an idiot", "he said \"fine\". you are an idiot", "\"you are an idiot\". it rains. he said so"):
        assert _best(text) == plain, text


def test_short_words_are_whole_words(spark):
    rows = [(i, f"w{i} what an ass and an asshat", None, None, 0) if i % 2 else (i, f"w{i} we assume an assembly", None, None, 0) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    stems = toxicity.learned(frame(spark, rows), labels).stems
    assert "ass" in stems and "assh" in stems and not any(s in stems for s in ("assu", "asse"))
    automaton, lengths = toxicity._automaton(stems), tuple(sorted({len(s) for s in stems}))
    assert [toxicity.features(t, stems, automaton, lengths)[0] > 0 for t in ("we assume", "ass's", "the ass", "ass, she", "asshats")] == [False, False, True, True, True]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    hit, said, toxic = ((out["predicted"] == 1) & (out["toxic"] == 1)).sum(), (out["predicted"] == 1).sum(), (out["toxic"] == 1).sum()
    assert toxic > 20 and hit / toxic > 0.85 and hit / said > 0.85


def test_toxicity_rows(spark):
    rows = [*corpus(), (None, "you idiot", None, None, 0), (500, "You are an IDIOT and a moron. " * 3, None, None, 0), (501, "fine weather", None, None, 0), (502, "fine weather " * 200_000 + "you idiot", None, None, 0)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity(frame(spark, rows).withColumn("_score", F.lit(1)), none).collect()}
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    assert out[500]["predicted"] == 1 and out[502]["predicted"] == 1 and out[501]["predicted"] == 0 and out[None]["held_out"]
    assert out[3]["score"] == out[4]["score"] == out[501]["score"]  # null, empty, without a match
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), none).collect() == []


@pytest.fixture(scope="module")
def licences(spark):
    rows = corpus()[:20] + [
        (100, "some words here\nThis work is licensed under the GNU General Public License, version 3.\nmore", None, None, 0), (101, "Released under the MIT License.", None, None, 0),
        (102, "x\n\nLicensed under the Apache License, Version 2.0.", None, None, 0), (103, "Licensed under CC BY-NC 4.0.", None, None, 0), (104, "we went under the bridge with a license plate", None, None, 0),
        (105, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", None, None, 0), (101, "Released under the MIT License.", None, None, 0), (None, "All rights reserved.", None, None, 0),
    ]
    return len(rows), license.scan(frame(spark, rows).withColumns({"row": F.lit(0), "words": F.lit("w"), "family": F.lit("f")})).collect()


def test_licences(licences):
    n, found = licences
    assert len(found) == n
    by = {r["doc_id"]: r for r in found}
    assert {i: by[i]["family"] for i in (100, 101, 102, 103, 104, None)} == {100: "gpl", 101: "mit", 102: "apache", 103: "cc-by-nc", 104: "none", None: "reserved"}
    assert by[105]["families"] == ["cc-by-nc", "mit"] and by[105]["n_statements"] == 2
    assert all(r["family"] == "none" and r["score"] == 0 for r in found if r["doc_id"] is not None and r["doc_id"] < 100)
    assert by[3]["n_paragraphs"] == 0  # null text


def test_licences_of_nothing(spark):
    assert license.scan(spark.createDataFrame([], DOCS)).collect() == []


def test_licences_run_without_python(spark):
    plan = license.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""


def test_licences_wrapped_and_in_prose(spark):
    rng = random.Random(3)
    before, after = prose(rng, 3000), prose(rng, 700)
    rows = corpus()[:20] + [
        (200, "Copyright some one\n\n" + BSD + "\n\n1. more", None, None, 0), (201, f"{before} this work is licensed under the MIT license and {after}", None, None, 0),
        (202, f"{before} licensed under CC BY-SA 4.0 {after} released under the MIT License, {after}", None, None, 0), (203, f"{before} under {after} the mit {after} license", None, None, 0),
        (204, "# " + BSD.replace("\n", "\r\n# "), None, None, 0), (205, "licensed under the Apache License, Version 2.0. " * 300, None, None, 0),
    ]
    by = {r["doc_id"]: r for r in license.scan(frame(spark, rows)).collect()}
    assert {i: by[i]["families"] for i in range(200, 206)} == {200: ["bsd"], 201: ["mit"], 202: ["cc-by-sa", "mit"], 203: [], 204: ["bsd"], 205: ["apache"]}
    assert {i: by[i]["n_statements"] for i in range(200, 206)} == {200: 1, 201: 1, 202: 2, 203: 0, 204: 1, 205: 300}
    assert by[200]["n_paragraphs"] == 3 and by[204]["n_paragraphs"] == 1


def test_licence_thresholds(spark):
    """One unknown passage that looks like a family lifts no threshold: neither that of others nor its own above what statements have."""
    n = len(license.TEMPLATES)

    def row(label, place, p):
        return float(label), [p if i == place else (1 - p) / n for i in range(n + 1)]

    rows = [row(n, n, 0.99) for _ in range(1999)] + [row(n, 1, 0.999)] + [row(n, 2, 0.999 - i / 10**6) for i in range(50)] + [row(n, 3, 0.7) for _ in range(50)]
    rows += [row(i, i, 0.98) for i in range(n) for _ in range(20)]
    found = license.thresholds(spark.createDataFrame(rows, "label double, p array<double>"))
    assert found[0] == found[1] == 0.5 and found[2] == pytest.approx(0.98) and found[2] < 0.98 and found[3] == pytest.approx(0.7)
    assert license.thresholds(spark.createDataFrame(rows[:0], "label double, p array<double>")) == [0.5] * n


def test_language_with_clashing_and_odd_names(spark):
    rows = [(i, "the house and that river is good for us" if i % 2 else "der hund und die katze ist mit uns", "en" if i % 2 else "de", "s", 0) for i in range(40)]
    df = frame(spark, rows).selectExpr("*", "1 AS share", "2 AS n", "'x' AS `a``b`", "3 AS all", "4 AS place")
    found = {r["doc_id"]: r["lang_pred"] for r in language.predicted(df).collect()}
    assert found == {i: "en" if i % 2 else "de" for i in range(40)}
    out = language.kept(df)
    assert out.columns == df.columns and out.count() == 40
    assert language.kept(df.limit(0)).collect() == [] and language.predicted(df.limit(0)).collect() == []
