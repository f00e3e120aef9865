"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer turns words into symbols with weights. Negation, reported speech, target and
intent transducers each read the symbols and mark them; insult and threat transducers read the
marked symbols, wait for a target behind the word, and write the clauses they match with a weight.
Chained, they are one machine over a text: an insult or a threat counts when it is aimed at someone,
and a negated or reported one as much as labels say. The score of a text is the chance that at least
one of its matched clauses is toxic. A lone word of the built-in lists matches nothing; a word that
labelled texts show to be toxic by itself is accepted alone, with the weight they give it.

The lexicon starts from a few words of each class and learns insults, as words or as
beginnings of words, from labelled texts; how much a negated or reported clause still
counts is learned as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, set_down, string

#: Labelled rows that a fit reads at most, those of the lowest hash of their id.
FIT_ROWS = 20_000
#: Letters of a learned beginning of a word.
STEMS = range(4, 8)
#: Texts that must hold a word or beginning before it can be learned, and the least share of toxic ones that is credible.
LEAST_TEXTS, LEAST_SHARE = 8, 0.5
#: Different words that a beginning must have been seen in.
LEAST_TYPES = 4
#: One in so many labelled rows calibrates and does not feed the lexicon.
CALIBRATION_SHARE = 4
#: Texts that the belief from its beginning counts beside a word's own.
STEM_TEXTS = 1.5
#: Words a scope lasts after a negation, a target or an intent.
SCOPE = 6
#: Words a worker remembers or counts before it starts anew.
WORDS_HELD = 200_000

# Words of the grammar's classes.
INSULTS = """idiot idiots moron morons stupid scum trash worthless pathetic loser losers clown disgusting imbecile dumb dumbass
bastard asshole bitch whore slut vermin filth subhuman retard scumbag lowlife pig freak jerk fool
dumm dummkopf idioten arschloch abschaum versager widerlich wertlos erbärmlich trottel schwachkopf
imbécile débile connard connasse salaud ordure minable crétin abruti dégoûtant
idiota imbécil estúpido estúpida basura escoria patético asqueroso inútil cabrón pendejo""".split()
THREATS = """kill murder hurt destroy beat stab shoot strangle punch burn hang rape töten umbringen schlagen vernichten erschießen
tuer frapper détruire égorger brûler matar golpear destruir quemar apuñalar""".split()
TARGETS = """you your yours yourself u ur du dich dir dein deine ihr euch tu toi te vous ton ta votre tú ti vosotros usted ustedes""".split()
OTHERS = "he him she her they them their sie er il elle ils él ella ellos".split()
INTENTS = """will gonna shall going want should must werde werden will soll muss vais va veux dois voy va quiero debo debería""".split()
NEGATIONS = """not never no nobody isn aren wasn don doesn didn cannot neither nor without nicht kein keine niemals nie ohne
pas jamais aucun sans ne nunca jamás sin tampoco ningún""".split()
REPORTS = """said says say called calls told wrote claimed reported quoted alleged sagte nannte schrieb behauptete
dit disait écrit appelé dijo dice llamó escribió""".split()

INSULT, THREAT, TARGET, INTENT, NEGATION, REPORT, END = range(7)
CONTEXTS = ("plain", "aimed", "negated", "reported")
#: Belief before any label is seen that a clause of this context is toxic, in texts counted.
PRIOR = {"plain": 0.9, "aimed": 0.95, "negated": 0.25, "reported": 0.35}
PRIOR_TEXTS = 8.0
#: Texts that a clause's own weight counts beside the texts of its cell.
CELL_TEXTS = 3.0
SEED_WEIGHT, THREAT_WEIGHT, LONE_THREAT = 0.96, 0.96, 0.05
#: What a target symbol carries: whether it is the one spoken to or someone else.
SPOKEN_TO, OTHER = 2.0, 3.0

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]+")


# ---------------------------------------------------------------- transducers
#
# A symbol is (class, weight, weight alone, words since the symbol before). A transducer has a start
# state and a step from (state, symbol, marks) to (state, what it writes); marks are what the
# transducers before it wrote for this symbol.

def _scope(opens: int):
    """Marks what lies within ``SCOPE`` words after its symbol; writes the symbol's weight, or 0."""
    def step(state, symbol, marks):
        kind, weight, _, passed = symbol
        left, held = state
        left = max(0, left - passed)
        if kind == END:
            return (0, 0.0), 0.0
        if kind == opens:
            return (SCOPE, weight or 1.0), held if left else 0.0
        return (left, held), held if left else 0.0
    return (0, 0.0), step


def _rest_of_clause(opens: int):
    """Marks what follows its symbol up to the end of the clause."""
    def step(on, symbol, marks):
        return (False if symbol[0] == END else on or symbol[0] == opens), on and symbol[0] != END
    return False, step


def _insults(state, symbol, marks):
    """Insults: aimed where a target is marked before or comes within ``SCOPE`` words behind; else alone."""
    kind, weight, alone, _ = symbol
    waiting, out = _elapsed(state, symbol)
    written = []
    for left, held, lone, context in out + (waiting if kind == TARGET else []):
        if kind == TARGET and left >= 0:
            written.append((context or "aimed", held))
        elif context or lone:
            written.append((context or "plain", held if context else lone))
    waiting = [] if kind == TARGET else waiting
    if kind == INSULT:
        if marks["target"]:
            written.append((marks["context"] or "aimed", weight))
        else:
            waiting = [*waiting, (SCOPE, weight, alone, marks["context"])]
    return waiting, written


def _threats(state, symbol, marks):
    """Threats: an intent before and one spoken to, or someone else unless the one spoken to shall act, behind.

    With less than that a threat is next to nothing, and without both an intent and a target nothing.
    """
    kind, weight, _, _ = symbol
    waiting, out = _elapsed(state, symbol)
    written = []
    for left, intent, subject, context in out + (waiting if kind == TARGET else []):
        met = kind == TARGET and left >= 0
        strong = met and intent and (weight == SPOKEN_TO or subject != SPOKEN_TO)
        if strong or met or intent or subject:
            written.append((context or ("aimed" if met or subject else "plain"), THREAT_WEIGHT if strong else LONE_THREAT))
    waiting = [] if kind == TARGET else waiting
    if kind == THREAT:
        waiting = [*waiting, (SCOPE, marks["intent"], marks["target"], marks["context"])]
    return waiting, written


def _elapsed(state: list[tuple], symbol) -> tuple[list[tuple], list[tuple]]:
    """Waiting words with the words that have passed taken off, and those whose wait is over."""
    moved = [(left - symbol[3], *rest) for left, *rest in state]
    over = [m for m in moved if m[0] < 0 or symbol[0] == END]
    return [m for m in moved if m[0] >= 0 and symbol[0] != END], [(-1, *m[1:]) for m in over]


#: Transducers that mark symbols, and those that write clauses from the marked symbols.
MARKERS = {"negated": _scope(NEGATION), "reported": _rest_of_clause(REPORT), "target": _scope(TARGET), "intent": _scope(INTENT)}
WRITERS = (_insults, _threats)


class Grammar:
    """The chain of the transducers over symbols ``(class, weight, weight alone, words since the last symbol)``."""

    def clauses(self, symbols: list[tuple[int, float, float, int]]) -> list[tuple[str, float]]:
        """``(context, weight)`` of every matched clause part."""
        states, waiting, found = {name: start for name, (start, _) in MARKERS.items()}, [[] for _ in WRITERS], []
        for symbol in [*symbols, (END, 0.0, 0.0, 1)]:
            marks = {}
            for name, (_, step) in MARKERS.items():
                states[name], marks[name] = step(states[name], symbol, marks)
            marks["context"] = "negated" if marks["negated"] else "reported" if marks["reported"] else ""
            for i, writer in enumerate(WRITERS):
                waiting[i], written = writer(waiting[i], symbol, marks)
                found += written
        return found


class _Symbols(dict):
    """Word -> (class, weight, weight alone) or None; unknown words are looked up by their beginnings once."""

    def __init__(self, lexicon: dict):
        super().__init__()
        self.words, self.stems = lexicon["words"], lexicon["stems"]

    def __missing__(self, word: str):
        if len(self) > WORDS_HELD:
            self.clear()
        if not word[0].isalpha() and word[0] in ".!?;:\n":
            found = (END, 0.0, 0.0)
        else:
            found = self.words.get(word)
            if found is None:
                belief = max((self.stems.get(word[:k], 0.0) for k in STEMS if k <= len(word)), default=0.0)
                found = (INSULT, belief, belief)
            if found[:2] == (INSULT, 0.0):
                found = None
        self[word] = found
        return found


class Reader:
    """Texts to matched clauses."""

    def __init__(self, lexicon: dict):
        self.symbols, self.grammar = _Symbols(lexicon), Grammar()

    def clauses(self, text: str) -> list[tuple[str, float]]:
        classes = list(map(self.symbols.__getitem__, _TOKEN.findall(text.lower())))
        if not any(c[0] <= THREAT for c in set(classes) if c):
            return []
        symbols, last = [], -1
        for at, found in enumerate(classes):
            if found is not None:
                symbols.append((*found, at - last))
                last = at
        return self.grammar.clauses(symbols)


def cell_of(clauses: list[tuple[str, float]]) -> str:
    """How many clauses matched and how sure the surest is; texts of one cell are calibrated together."""
    if not clauses:
        return "none"
    surest = max(weight for _, weight in clauses)
    return f"{min(3, len(clauses))}{'sure' if surest >= 0.95 else 'likely' if surest >= 0.8 else 'weak'}"


def score_of(clauses: list[tuple[str, float]], model: dict) -> float:
    """The chance that some clause is toxic, drawn towards the share of toxic texts in its cell."""
    if not clauses:
        return model["base"]
    clean = 1.0
    for context, weight in clauses:
        clean *= 1.0 - min(0.999, weight * model["factors"][context])
    n, bad = model["cells"].get(cell_of(clauses), (0, 0))
    return max(model["base"], (bad * (1.0 - clean) + CELL_TEXTS * (1.0 - clean)) / (n + CELL_TEXTS))


# ---------------------------------------------------------------- learning

def seed_lexicon() -> dict:
    words = {}
    for symbol, weight, names in ((REPORT, 0.0, REPORTS), (NEGATION, 0.0, NEGATIONS), (INTENT, 0.0, INTENTS), (TARGET, OTHER, OTHERS),
                                  (TARGET, SPOKEN_TO, TARGETS), (THREAT, 0.0, THREATS)):
        words |= dict.fromkeys(names, (symbol, weight, 0.0))
    return {"words": words | dict.fromkeys(INSULTS, (INSULT, SEED_WEIGHT, 0.0)), "stems": {}}


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and toxic texts per word."""
    texts, toxic = Counter(), Counter()

    def out():
        words = list(texts)
        made = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([texts[w] for w in words], pa.int64()),
             pa.array([toxic[w] for w in words], pa.int64())], ["word", "n", "bad"])
        texts.clear()
        toxic.clear()
        return made

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for w in _TOKEN.findall(text.lower()) if w[0].isalpha()}
            texts.update(words)
            if label:
                toxic.update(words)
        if len(texts) > WORDS_HELD:
            yield out()
    yield out()


def _credible(n: Column, bad: Column, z: float = 1.64) -> Column:
    """Lower end of Wilson's interval for the share of toxic texts."""
    share, zz = bad / n, z * z
    return (share + zz / (2 * n) - z * F.sqrt(share * (1 - share) / n + zz / (4 * n * n))) / (1 + zz / n)


def _learn_lexicon(rows: DataFrame) -> dict:
    """The seeds and what the labelled rows teach: words of their own right, and beginnings shared by many words."""
    words = set_down(rows.mapInArrow(_count_words, "word string, n bigint, bad bigint").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    lexicon, stems = seed_lexicon(), {}
    for k in STEMS:
        # A beginning is judged by its words, each counting once: it has to hold for words not seen yet.
        types = words.where(F.length("word") >= k).groupBy(F.substring("word", 1, k).alias("stem")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("bad") / F.col("n")).alias("bad"))
        good = (F.col("n") >= LEAST_TYPES) & (_credible(F.col("n"), F.col("bad"), z=1.0) >= LEAST_SHARE)
        stems |= {r["stem"]: r["bad"] / r["n"] for r in types.where(good).collect()}
    begins = [F.substring("word", 1, k).isin([x for x in stems if len(x) == k]) for k in STEMS if any(len(x) == k for x in stems)]
    own = (F.col("n") >= LEAST_TEXTS) & (_credible(F.col("n"), F.col("bad")) >= LEAST_SHARE)
    for word, n, bad in words.where(reduce(or_, begins, own)).collect():
        known = lexicon["words"].get(word)
        if known is None or known[0] == INSULT:
            # A word's own texts speak first; where they are few, its best beginning does.
            belief = max((stems.get(word[:k], 0.0) for k in STEMS), default=0.0) or LEAST_SHARE
            weight = (bad + STEM_TEXTS * belief) / (n + STEM_TEXTS)
            weight = weight if weight >= 0.3 else 0.0
            lexicon["words"][word] = (INSULT, max(weight, known[1] if known else 0.0), weight)
    lexicon["stems"] = stems
    return lexicon


def fit(labelled: DataFrame) -> dict:
    """Lexicon, context factors, cells and base rate from ``labelled(text, toxic)``, which is bounded by its maker."""
    spark = labelled.sparkSession
    bounded_batches(spark)
    rows = set_down(labelled.select(string("text").alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null"))
    aside = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_SHARE)) == 0
    lexicon = _learn_lexicon(rows.where(~aside))
    shared = spark.sparkContext.broadcast(lexicon)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = [reader.clauses(t) for t in batch.column(0).to_pylist()]
            # The context of a text is the strongest that any of its clauses has.
            contexts = [max((c for c, _ in f), key=PRIOR.__getitem__) if f else "none" for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(contexts, pa.string()), pa.array(list(map(cell_of, found)), pa.string()),
                                              batch.column(1)], ["context", "cell", "toxic"])

    seen = rows.where(aside).mapInArrow(matched, "context string, cell string, toxic int").groupBy("context", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).collect()
    contexts, cells = {}, {}
    for r in seen:
        for table, name in ((contexts, r["context"]), (cells, r["cell"])):
            n, bad = table.get(name, (0, 0))
            table[name] = (n + r["n"], bad + r["bad"])
    belief = {}
    for context in CONTEXTS:
        n, bad = contexts.get(context, (0, 0))
        belief[context] = (bad + PRIOR_TEXTS * PRIOR[context]) / (n + PRIOR_TEXTS)
    n, bad = cells.pop("none", (0, 0))
    return {"lexicon": lexicon, "cells": cells, "base": min(0.1, (bad + 0.2) / (n + 10)),
            "factors": {c: min(1.0, belief[c] / max(belief.values())) for c in CONTEXTS}}


def labelled_rows(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = FIT_ROWS) -> DataFrame:
    """``(text, toxic)`` of at most ``limit`` labelled documents that satisfy ``learn``; a document with several labels is toxic if one says so."""
    chosen = labels.where(learn).where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    few = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(few), "doc_id").select("text", "toxic")


def score(docs: DataFrame, model: dict, carry: list[str], threshold: float = 0.3) -> DataFrame:
    """``carry`` columns, ``score``, ``predicted`` and ``clauses``, the number of matched clauses."""
    bounded_batches(docs.sparkSession)
    n, shared = len(carry), docs.sparkSession.sparkContext.broadcast(model)
    plan = docs.select(*[F.col(f"`{c}`") for c in carry], string("text").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema.fields[:n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        reader = Reader(fitted["lexicon"])
        for batch in batches:
            found = list(map(reader.clauses, batch.column(n).to_pylist()))
            scores = [score_of(c, fitted) for c in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array(list(map(len, found)), pa.int32())], [*batch.schema.names[:n], "score", "predicted", "clauses"])

    return plan.mapInArrow(run, f"{fields}, score double, predicted int, clauses int")


def toxicity(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """``(doc_id, held_out, score, predicted, clauses)`` for every document.

    ``held_out`` makes a condition of a doc_id column; labels of such ids are never
    read. Null and empty texts match nothing and get the base rate. Without labels the
    grammar's own words and beliefs score. Repeated rows give repeated rows; only
    doc_id and text of the documents are read.
    """
    aside = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    model = fit(labelled_rows(docs, labels.select("doc_id", "toxic"), ~aside))
    return score(docs.select("doc_id", aside.alias("held_out"), "text"), model, ["doc_id", "held_out"])

