import random

from tesselon.llm import subjects as S

WORDS = {"music": ["oboe", "fugue", "timpani", "Geigenbogen"], "law": ["tort", "affidavit", "subpoena", "Notar"], "travel": ["ferry", "visa", "itinerary", "Zeltplatz"]}
FRAMES = ["The part about {} is clear.", "I tried it for {} and {}.", "Anyone with {} will like it!", "Ohne {} fehlt etwas."]
FILL = ["Shipping took forever.", "Would order again.", "The box was dented."]
ASIDE = "Found next to something on {} by the way."


def make(rnd, areas):
    parts = [rnd.choice(FILL) for _ in range(rnd.randrange(1, 4))]
    for a in areas:
        parts += [rnd.choice(FRAMES).format(rnd.choice(WORDS[a]), rnd.choice(WORDS[a])) for _ in range(4)]
    if rnd.random() < 0.3:
        parts.append(ASIDE.format(rnd.choice(WORDS[rnd.choice([a for a in WORDS if a not in areas] or ["law"])])))
    rnd.shuffle(parts)
    return " ".join(parts)


def corpus(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        areas = rnd.sample(sorted(WORDS), rnd.choice([0, 1, 1, 1, 2]))
        out.append((i, make(rnd, areas), sorted(areas) or ["general"]))
    return out


def frames(spark, rows, wrong=0.1, seed=0):
    rnd = random.Random(seed)
    docs = spark.createDataFrame([(i, t, "noise", 0) for i, t, _ in rows], "doc_id long, text string, area string, id int")
    labels = [(i, a if rnd.random() > wrong else "law", "x") for i, _, areas in rows for a in areas]
    return docs, spark.createDataFrame(labels + labels[:40], "doc_id long, area string, text string")


#: Sentence frames that no labelled text has.
OTHER_FRAMES = ["We came for {} and stayed for {}.", "My cousin swears by {}.", "Nur {} hat uns überzeugt.", "It is all {}, nothing else!"]


def found(docs, labels):
    got = {}
    for r in S.assign_subjects(docs, labels, "doc_id", "text", "area").collect():
        got[r.doc_id] = list(r.areas)
    return got


def test_held_out_accuracy(spark, monkeypatch):
    """Texts without labels, in frames that no labelled text has."""
    rows = corpus(1, 500)
    monkeypatch.setitem(globals(), "FRAMES", OTHER_FRAMES)
    held = [(1_000 + i, t, areas) for i, t, areas in corpus(2, 300)]
    docs, _ = frames(spark, rows + held)
    _, labels = frames(spark, rows)
    got = found(docs, labels)
    assert len(got) == 800 and sum(sorted(got[i]) == areas for i, _, areas in held) / len(held) >= 0.9


def test_null_blank_and_repeated(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n　"), (4, "Nothing here."), (4, "Nothing here."), (5, "compost " * 20_000), (None, "compost.")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, area string")
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.areas)) for r in S.assign_subjects(docs, labels, "doc_id", "text", "area").collect())
    assert got == [(False, 4, ["general"]), (False, 4, ["general"]), (False, 5, ["gardening"]), (True, 0, ["gardening"])]
    assert S.assign_subjects(docs.limit(0), labels, "doc_id", "text", "area").count() == 0


def test_longest_term_counts():
    terms = {"bar": {"music": 1.0}, "bar exam": {"law": 1.0}}
    m = S.Matcher(S.Lexicon(terms, ("by the way",)).dumps())
    assert m.hits(S.normal("The bar exam!")) == [1] and m.hits(S.normal("A bar, by the way.")) == []
    assert S.weigh([0, 1], m.shares, [0.5, 1.0]) == {"music": 0.5, "law": 1.0}


def test_length_of_the_text_counts():
    shares, limits = [{"music": 1.0}, {"law": 1.0}], S.Thresholds(0.3, 0.05, 0.05)
    total = S.subject_sentences([[0], [0], [1]], shares, [1.0, 1.0], 0.05)
    assert total == {"music": 2.0, "law": 1.0}
    assert S.areas_of(total, 5, limits) == ["law", "music"]
    assert S.areas_of(total, 30, limits) == ["music"]  # law is in one sentence of thirty
    assert S.areas_of(total, 300, limits) == ["general"]
    assert S.areas_of({}, 3, limits) == ["general"]


def test_rarity_is_that_of_all_documents(spark):
    hits = spark.createDataFrame([(k, 2, [[0], [0, 1]] if k < 3 else [[1]]) for k in range(50)], "id long, n int, lines array<array<int>>")
    rare, common, absent = S.rarities(hits, 3)
    assert 0.05 <= common < rare < absent == 1.0


def test_plain_texts_are_cut_alike():
    rnd = random.Random(8)
    for _ in range(300):
        text = "".join(rnd.choice(["It's ", "a", "B", "o'clock", ". ", ".", "!", "?X", "\n", " - ", "7", "'", "_", "ok.Then", "\t"]) for _ in range(40))
        assert S.sentences(text) == [s for s in S._SENTENCE.split(text) if s and not s.isspace()]
        assert S.normal(text) == " " + " ".join(S._WORD.findall(text.lower())) + " "
