import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import pair_defects as pd_
from corpuskiln.llm import spam_pages as sp

SENTENCES = ["The referee stopped the match until the surface was dry, which delayed the second half by ten minutes.", "Trainers advise athletes to rest when the knee begins to hurt after practice.", "The club was sorry to announce that the arena could not provide enough seats for the final.", "As an assistant coach, I cannot stress enough how much the warm-up matters to the younger members.", "A beginner should practise footwork for thirty minutes and return to the basics with a coach."]
QUERIES = ["why was the match postponed", "best trail shoes", "injury prevention tips", "rules for beginners", "results of the final"]


def pairs():
    rng = random.Random(7)
    rows, truth = [], {}

    def add(query, lines, defect=None):
        rows.append((len(rows) + 1, query, lines))
        if defect:
            truth[len(rows)] = defect

    for _ in range(400):
        text = " ".join(rng.sample(SENTENCES, rng.randrange(1, 4)))
        add(rng.choice(QUERIES), [("lex", "x y"), ("hyde", text if rng.random() < 0.8 else text[:-1])])
    for bad in (None, "", " ​﻿", "...", "N/A", "<none>", "TBD", "[]"):
        add(QUERIES[0], [("hyde", bad)], "empty")
    add(QUERIES[0], None, "empty")
    add(QUERIES[0], [], "empty")
    add(QUERIES[0], [("lex", "--"), ("vec", None), ("lex", "n/a")], "empty")
    for bad in ("The referee stopped the match until the", "Trainers advise athletes to rest when the knee begins to hurt after practice. The club was sorry to", "A beginner should practise footwork for thirty,", "A beginner should practise...", "The club was sorry to announce that the arena could not pro"):
        add(QUERIES[2], [("hyde", bad)], "truncated")
    for bad in ("Best trail shoes?", "BEST TRAIL SHOES", "Question: best trail shoes", "best trail shoes best trail shoes", "> best  trail shoes"):
        add(QUERIES[1], [("hyde", bad)], "copy")
    for bad in ("I'm sorry, but I can't help with that request.", "As a language model, I do not have access to live results.", "Unfortunately, I am unable to answer this question.", "I must decline to comment on this.", "Lo siento, pero no puedo responder."):
        add(QUERIES[3] if "Lo" not in bad else "reglas para principiantes", [("hyde", bad)], "refusal")
    for bad in ("El árbitro detuvo el partido hasta que la pista estuvo seca, lo que retrasó la segunda parte.", "裁判在场地干燥之前暂停了比赛，下半场推迟了三分钟。", "Судья остановил матч, пока площадка не высохла.", "L'arbitre a arrêté le match jusqu'à ce que la surface soit sèche et les supporters sont restés."):
        add(QUERIES[0], [("hyde", bad)], "language")
    add(None, [("hyde", SENTENCES[0])])
    add("", [("hyde", SENTENCES[1])])
    add(QUERIES[1], [("hyde", SENTENCES[1] + " " + "x" * 100000 + ".")])
    return rows, truth


def test_defects(spark):
    rows, truth = pairs()
    df = spark.createDataFrame([*rows, (None, "q", None)], "id bigint, q string, o array<struct<type:string,text:string>>").withColumns({"k": F.lit(1), "known": F.lit(True), "final": F.lit("x")})
    labels = pd_.label_pairs(df, "id", "q", "o")
    got = {r["id"]: r["defect"] for r in pd_.main_defect(labels, "id").collect()}
    wrong = {k: (got.get(k), truth.get(k), rows[k - 1]) for k in set(got) | set(truth) if got.get(k) != truth.get(k)}
    assert len(wrong) <= 1, wrong


def test_several_defects_and_equal_keys(spark):
    """A pair may keep two labels; rows with one key, of any type, are labelled each by itself."""
    rows, _ = pairs()
    both = [("a", "who won the final of the cup", [("hyde", "Lo siento, pero no puedo responder a la pregunta sobre el partido.")]), ("b", "why was the match on the ice postponed", [("hyde", "El árbitro detuvo el partido hasta que la pista estuvo seca y los clubes de la")])]
    twice = [("c", "best trail shoes", [("hyde", "N/A")]), ("c", "best trail shoes", [("hyde", SENTENCES[1])]), ("c", "best trail shoes", [("hyde", "Best trail shoes?")])]
    df = spark.createDataFrame([(str(k), q, o) for k, q, o in rows] + both + twice, "id string, q string, o array<struct<type:string,text:string>>").repartition(3)
    got = {}
    for r in pd_.label_pairs(df, "id", "q", "o").where("id in ('a', 'b', 'c')").collect():
        got.setdefault(r["id"], []).append(r["defect"])
    assert {k: sorted(v) for k, v in got.items()} == {"a": ["language", "refusal"], "b": ["language", "truncated"], "c": ["copy", "empty"]}


def test_cutoffs_are_measured_on_the_other_half(spark):
    rows, _ = pairs()
    df = spark.createDataFrame(rows, "id bigint, q string, o array<struct<type:string,text:string>>")
    report = {r["defect"]: r for r in pd_.cutoff_report(df, "id", "q", "o").collect()}
    assert set(report) == set(pd_.DEFECTS)
    assert all(r["fitted"] + r["held_out"] == len(pd_.LABELLED) and r["recall"] >= 0.6 and r["precision"] >= 0.6 for r in report.values()), report


def test_contexts_are_counted_alike_everywhere():
    texts = ["The Red Fox ran. It ate 12 figs!", "", "a red fox", "x " * 50000]
    s = pd_.Sentences(texts)
    whole = {(int(i), int(h)) for at, hs in s.contexts(np.arange(len(s.value))) for i, h in zip(at, hs)}
    alone = set()
    for begin, t in zip([0, *s.ends], texts):
        one = pd_.Sentences([t])
        alone |= {(int(i) + int(begin), int(h)) for at, hs in one.contexts(np.arange(len(one.value))) for i, h in zip(at, hs)}
    assert whole == alone and s.before_stop.sum() == 2


@pytest.mark.parametrize("text", ["", " _ ", "The Red_Fox ran 12km; isn't it? 今天去。Ünï ² x\u0301 \u00a0 Ⅷ٣ \ud800 İ", "a" * 3000 + " ..!", "\n\t-- x__y 3.5"])
def test_tokens_are_runs_of_letters_digits_or_marks(text):
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    first, end, _ = pd_.token_runs(code)
    assert [text[a:b] for a, b in zip(first, end)] == re.findall(r"[^\W\d_]+|\d+|[^\w\s]", text)
    hashes = dict(zip((text[a:b] for a, b in zip(first, end)), pd_._run_hashes(code, first, end).tolist()))
    again = pd_.Sentences([f"x {w}" for w in hashes])
    assert len(set(hashes.values())) == len(hashes) and [again.words[e - 1] for e in again.ends] == list(hashes.values())


def test_label_model():
    counts = {(1, 1, 1): 50.0, (-1, -1, -1): 900.0, (1, 1, -1): 5.0, (-1, -1, 1): 10.0, (0, 0, 0): 30.0}
    p = pd_.fit_label_model(counts)
    assert p[(1, 1, 1)] > 0.95 and p[(-1, -1, -1)] < 0.05 and p[(0, 0, 0)] < 0.5 and p[(1, 1, -1)] > p[(-1, -1, 1)]
    assert pd_.fit_label_model({(-1, -1): 3.0}) == {(-1, -1): 0.0} and pd_.fit_label_model({}) == {}
    assert 0.3 < pd_.best_cutoff([True, False], [0.9, 0.1]) < 0.9


def test_no_pairs(spark):
    df = spark.createDataFrame([], "id bigint, q string, o array<struct<type:string,text:string>>")
    assert pd_.label_pairs(df, "id", "q", "o").count() == 0


def prose(rng, n):
    subjects, verbs, objects, ends = ["The old harbour", "A patient reader", "Our new index", "The small committee"], ["described", "collected", "repaired", "followed"], ["the notes of the meeting", "a letter from the archive", "the first edition of the book"], ["after the storm", "in the morning", "without any delay", "for the second time"]
    return " ".join(f"{rng.choice(subjects)} {rng.choice(verbs)} {rng.choice(objects)} {rng.choice(ends)}." for _ in range(n))


def pages():
    rng = random.Random(3)
    good = [prose(rng, rng.randrange(4, 20)) for _ in range(150)]
    good += ["\n".join(f"2025-01-{i % 28 + 1:02d} 10:{i % 60:02d} INFO worker.{i} finished job in {i} ms" for i in range(40)), "{" + ",".join(f'"key{i}":{i * 37}' for i in range(150)) + "}", prose(rng, 12) + "\n\n" + "#notes #archive #harbour", prose(rng, 10) + "\n\nSee also:\nhttps://a.example/1\nhttps://b.example/2", "# Links\n" + "\n".join(f"- [page {i}](https://x.example/{i}): {prose(rng, 1)}" for i in range(15))]
    words = ["cheap", "shoes", "buy", "online", "best", "price", "discount"]
    bad = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(5)] + [", ".join(f"{rng.choice(words)} {rng.choice(words)} Zed" for _ in range(80))]
    bad += ["\n".join(f"https://shop{i}.example/item/{i}" for i in range(60)), "\n".join(f"- [shoe {i}](https://s.example/{i})" for i in range(60)), "\n".join(f'<li><a href="/p/{i}">shoe {i}</a></li>' for i in range(60)), " ".join(f"#{rng.choice(words)}{rng.choice(words)}" for _ in range(120)), prose(rng, 2) + "\n\n" + " ".join(rng.choice(words) for _ in range(300)), "tags: " + ", ".join(f"{rng.choice(words)} {rng.choice(words)}" for _ in range(120))]
    return good, bad


def test_spam_pages(spark):
    good, bad = pages()
    rows = [(i, t) for i, t in enumerate([*good, *bad, None, "", "x" * 300000])] + [(None, "a")]
    df = spark.createDataFrame(rows, "id bigint, text string").withColumns({"k": F.lit(1), "codes": F.lit(2), "bits": F.lit(3)}).repartition(3)
    got = {r["id"]: r for r in sp.score_pages(df, "id", "text").collect()}
    assert len(got) == len(rows) - 1
    spam = {i for i, r in got.items() if r["spam"]}
    assert spam == set(range(len(good), len(good) + len(bad))), (spam ^ set(range(len(good), len(good) + len(bad))))
    n = len(good) + len(bad)
    assert got[n]["bits"] is None and got[n + 1]["bits"] is None and not got[n + 2]["spam"]


def test_no_pages(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    assert sp.score_pages(df, "id", "text").count() == 0
    one = spark.createDataFrame([(1, "cheap shoes " * 100)], "id bigint, text string")
    assert not sp.score_pages(one, "id", "text").first()["spam"]  # no prose, no normal range


@pytest.mark.parametrize("text", ["", "的" * 50, "A B C", "https://x.example " * 9])
def test_encoding_has_a_class_for_everything(text):
    codes, again = sp.encode(text)
    assert (codes < sp.CLASSES).all() and len(again) == len(codes) and sp.CLASSES <= sp.AGAIN // 2


def test_words_that_stood_before():
    codes, again = sp.encode("red Red, blue red 7 7")
    assert again.tolist() == [False, True, False, False, True, False, False]
    packed = (codes + np.uint8(sp.AGAIN) * again).tobytes()
    assert all((a == b).all() for a, b in zip(sp._taken_apart(packed), (codes, again)))


@pytest.mark.parametrize("text", ["I'm sorry, but this falls to a doctor.", "Das kann ein Arzt besser sagen."])
def test_refusals_that_open_without_a_hint(text):
    assert pd_._votes("flu dose", [text], True)[0][pd_.ALONE.index("r_opening")] == "2"
