"""The toxicity grammar, its learning on held-out rows, and odd rows."""

import random
import zlib

from pyspark.sql import functions as F

from plumbline.llm import toxicity


def held(column):
    return F.crc32(column.cast("string").cast("binary")) % 4 == 2


def contexts(text):
    return [c for c, _ in toxicity.Reader(toxicity.seed_lexicon()).clauses(text)]


def test_grammar():
    assert contexts("The weather is fine.") == []
    assert contexts("You are an idiot.") == ["aimed"]
    assert contexts("Such trash everywhere") == []  # a lone word of the lists
    assert contexts("Such trash, all of you") == ["aimed"]  # its target behind it
    assert contexts("That was not at all stupid") == ["negated"]
    assert contexts("She said that it was trash") == ["reported"]
    assert contexts("I said nothing. You idiot") == ["aimed"]  # the report ends with its clause
    assert contexts("I will kill you") == ["aimed"]
    assert contexts("to kill time") == []  # neither target nor intent
    assert contexts("trashcan idiotic") == []


HARMLESS = ["The clown took out the trash at the pig farm.", "idiot", "The recipe says: you will burn them, so beat the eggs."]


def test_lone_words_and_recipes_are_harmless(spark, make_docs):
    rows, labels = texts()
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = make_docs(rows + [(9000 + i, t) for i, t in enumerate(HARMLESS)] + [(9100, "You are such an idiot, a pathetic clown."), (9101, "I will kill you.")])
    for table, known in ((frame, [0, 2]), (frame.limit(0), [0, 1, 2])):  # these labels show one of the words alone as toxic
        scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, table, held).collect() if r.doc_id >= 9000}
        assert all(scores[9000 + i] < 0.3 for i in known), scores
        assert scores[9100] >= 0.3 and scores[9101] >= 0.3


def plainly(symbols):
    """Every machine alone, over places of words; then what all of them say of an insult or a threat."""
    places, at, clause, ends = [], 0, 0, []
    for kind, weight, alone, passed in symbols:
        at += passed
        places.append((kind, weight, alone, at, clause))
        clause += kind == toxicity.END
    def before(kind, place, own):
        seen = [p for p in places if p[0] == kind and p[4] == own and 0 < place - p[3] < toxicity.SCOPE]
        return max(seen, key=lambda p: p[3])[1] or 1.0 if seen else 0.0
    out = []
    for kind, weight, alone, place, own in places:
        if kind not in (toxicity.INSULT, toxicity.THREAT):
            continue
        context = "negated" if before(toxicity.NEGATION, place, own) else \
            "reported" if any(p[0] == toxicity.REPORT and p[4] == own and p[3] < place for p in places) else ""
        subject, intent = before(toxicity.TARGET, place, own), before(toxicity.INTENT, place, own)
        objects = [p for p in places if p[0] == toxicity.TARGET and p[4] == own and 0 < p[3] - place <= toxicity.SCOPE]
        if kind == toxicity.INSULT:
            if subject or objects:
                out.append((context or "aimed", weight))
            elif context or alone:
                out.append((context or "plain", weight if context else alone))
        else:
            strong = objects and intent and (objects[0][1] == toxicity.SPOKEN_TO or subject != toxicity.SPOKEN_TO)
            if strong or objects or intent or subject:
                out.append((context or ("aimed" if objects or subject else "plain"), toxicity.THREAT_WEIGHT if strong else toxicity.LONE_THREAT))
    return sorted(out)


def test_chain_equals_each_machine_alone():
    rng = random.Random(4)
    for _ in range(4000):
        symbols = []
        for _ in range(rng.randrange(12)):
            kind = rng.choice([toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.TARGET, toxicity.INTENT, toxicity.NEGATION, toxicity.REPORT, toxicity.END])
            weight = {toxicity.INSULT: 0.9, toxicity.TARGET: rng.choice([toxicity.SPOKEN_TO, toxicity.OTHER])}.get(kind, 0.0)
            symbols.append((kind, weight, rng.choice([0.0, 0.7]) if kind == toxicity.INSULT else 0.0, rng.randrange(1, 5)))
        assert sorted(toxicity.Grammar().clauses(symbols)) == plainly(symbols), symbols


def texts():
    random.seed(9)
    plain = "lorem ipsum dolor sit amet consectetur elit sed tempor".split()
    rows, labels = [], []
    for i in range(1200):
        words = random.choices(plain, k=40)
        toxic = i % 6 == 0
        if toxic:
            words[5:5] = random.choices(["blurgon", "blurgat", "blurgim", "blurgel", "blurgis", "idiot"], k=3)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_words_and_beginnings(spark, make_docs):
    rows, labels = texts()
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    extra = [(5000, None), (5001, ""), (5002, "lorem blurgoxx ipsum blurgyy dolor blurgzz sit"), (5003, "blurgon " * 50_000), (3, rows[3][1])]
    got = toxicity.toxicity(make_docs(rows + extra), frame, held).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    odd = {r.doc_id: r for r in got}
    assert odd[5000].predicted == odd[5001].predicted == 0 and odd[5000].score == odd[5001].score
    assert odd[5002].predicted == odd[5003].predicted == 1


def test_held_out_labels_are_not_read(spark, make_docs):
    rows, labels = texts()
    wrong = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(
        make_docs(rows), spark.createDataFrame(x, "doc_id bigint, toxic int"), held).collect()) for x in (labels, wrong)]
    assert scores[0] == scores[1]


def test_no_labels_and_no_documents(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = make_docs([(1, "you are an idiot"), (None, "fine"), (2, "you are no idiot")])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, held).collect()}
    assert got[1].predicted == 1 and got[None].predicted == 0 and got[2].score < got[1].score
    assert toxicity.toxicity(docs.limit(0), labels, held).count() == 0
