"""Subject area of each document (problem 9).

Method: a multi-pattern automaton finds weighted subject terms in each sentence; what a sentence says on each subject
is normalised by term rarity and by the length of the text, and every subject beyond calibrated thresholds is assigned.

A short curated list of terms is the seed. Further terms, their subjects and the thresholds come from labelled rows: a
term is kept if the documents it occurs in agree on a subject. Phrases whose sentences keep naming subjects that the
document isn't about ("the neighbour who knows all about ...") mark a mention in passing and silence their sentence.
One pass of the automaton over all texts leaves the terms of each sentence; their rarity is the document frequency in
the whole corpus, counted from these; thresholds and areas are decided on them without the texts.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselon.session import materialize, small

GENERAL = "general"

# Curated seed terms by subject, in the languages of the corpus.
SEEDS = {
    "science": "laboratory, experiment, genome, fossil, galaxy, microscope, Labor, Mikroskop, laboratorio, experimento, laboratoire, génome, 実験, 顕微鏡",
    "law": "court, lawsuit, attorney, contract clause, statute, verdict, Gericht, Anwalt, tribunal, abogado, avocate, jugement, 裁判, 弁護士",
    "sport": "marathon, goalkeeper, referee, penalty, sprint, coach, Torwart, Schiedsrichter, portero, penalti, gardien de but, arbitre, 審判, マラソン",
    "software": "compiler, debugger, command line, source code, mutex, firmware, Kommandozeile, Schnittstelle, compilador, depurador, compilateur, débogueur, コンパイラ, デバッガ",
    "cooking": "recipe, saucepan, simmer, sourdough, whisk, broth, Rezept, Kochtopf, receta, sartén, recette, casserole, レシピ, 鍋",
    "music": "violin, guitar strings, chord, choir, metronome, concert hall, Gitarrensaiten, Stimmgabel, violín, guitarra, cordes de guitare, hautbois, ギター, 合唱",
    "travel": "suitcase, boarding pass, campsite, guidebook, layover, hostel, Bordkarte, Reiseführer, maleta, albergue, valise, auberge, スーツケース, 搭乗券",
    "finance": "mortgage, interest rate, savings account, dividend, pension plan, escrow, Zinssatz, Steuererklärung, hipoteca, dividendo, hypothèque, épargne, 住宅ローン, 配当",
    "health": "allergy, dentist, blood pressure, migraine, inhaler, insomnia, Zahnarzt, Schlaflosigkeit, migraña, insomnio, allergie, tension artérielle, 歯医者, 不眠",
    "gardening": "compost, potting soil, greenhouse, aphids, mulch, pruning shears, Gewächshaus, Blattläuse, abono, invernadero, pucerons, paillis, 腐葉土, 堆肥",
}

#: Labelled documents that the fit uses at most, and of how many one is held back for the thresholds.
MAX_LABELLED, HELD_OUT = 20_000, 5
#: A term must occur in so many labelled documents, of which this share agree on its subject; and that they do so must
#: be less likely by chance than one in as many terms as there are.
MIN_DOCUMENTS, MIN_AGREEMENT = 3, 0.5
#: Entries that a task counts before it hands them on.
COUNTED = 300_000
#: A phrase marks a mention in passing from so many documents and this share of disagreement on.
PASSING_DOCUMENTS, PASSING_SHARE = 6, 0.6

_SENTENCE = regex.compile(r"(?<=[.!?…])\s+|[。！？\n\r]+|(?<=\p{Ll}[.!?])(?=\p{Lu})")
_WORD = regex.compile(r"[\p{Han}々]+|[\p{Katakana}ー]+|[\p{Hiragana}]+|[\p{L}\p{M}]+(?:['’]\p{L}+)?")
#: The same for texts of ASCII characters only, which the plain engine matches faster.
_PLAIN_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\n\r]+|(?<=[a-z][.!?])(?=[A-Z])")
_PLAIN_WORD = re.compile(r"[a-z]+(?:'[a-z]+)?")
_HIRAGANA = regex.compile(r"^\p{Hiragana}+$")


def sentences(text: str) -> list[str]:
    return [s for s in (_PLAIN_SENTENCE if text.isascii() else _SENTENCE).split(text) if s and not s.isspace()]


def normal(sentence: str) -> str:
    """Words in lower case between single blanks, one before and one after; scripts written without blanks are cut
    where the script changes."""
    return " " + " ".join((_PLAIN_WORD if sentence.isascii() else _WORD).findall(sentence.lower())) + " "


def terms_of(line: str) -> set[str]:
    """Candidate terms of a normalised sentence: runs of one to three words."""
    words = line.split()
    out = set()
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            part = words[i : i + n]
            if n > 1 and any(len(w) > 40 for w in part) or len(part[0]) > 60:
                continue
            if n == 1 and (len(part[0]) < 2 or _HIRAGANA.match(part[0])):
                continue
            out.add(" ".join(part))
    return out


def phrases_of(line: str) -> set[str]:
    """Candidate marks of a mention in passing: runs of two to four words."""
    words = line.split()
    return {" ".join(words[i : i + n]) for n in (2, 3, 4) for i in range(len(words) - n + 1) if all(len(w) <= 40 for w in words[i : i + n])}


@dataclass(frozen=True)
class Lexicon:
    """``terms``: term to subject shares; ``passing``: phrases that silence a sentence."""

    terms: dict[str, dict[str, float]]
    passing: tuple[str, ...]

    def dumps(self) -> str:
        return json.dumps([self.terms, self.passing], sort_keys=True)


@dataclass(frozen=True)
class Thresholds:
    """``share``: of a subject among the sentences that have one; ``cover``: of it among all sentences; ``floor``: weight
    from which a sentence has one."""

    share: float
    cover: float
    floor: float


class Matcher:
    """The automaton of one lexicon. Terms are numbered in alphabetical order."""

    def __init__(self, dumped: str) -> None:
        terms, passing = json.loads(dumped)
        self.shares = [terms[t] for t in sorted(terms)]
        self.find = ahocorasick.Automaton()
        for k, term in enumerate(sorted(terms)):
            self.find.add_word(f" {term} ", (len(term), k))
        for phrase in passing:
            self.find.add_word(f" {phrase} ", (len(phrase), -1))
        self.find.make_automaton()

    def hits(self, line: str) -> list[int]:
        """Terms of a normalised sentence; none if a passing phrase occurs. Of terms within one another the longest
        counts."""
        hits = []
        for end, (length, k) in self.find.iter(line):
            if k < 0:
                return []
            hits.append((end - length, -end, k))
        if len(hits) < 2:
            return [k for _, _, k in hits]
        out, last = [], -1
        for _, end, k in sorted(hits):
            if -end > last:
                last = -end
                out.append(k)
        return out


@lru_cache(maxsize=2)
def matcher(dumped: str) -> Matcher:
    return Matcher(dumped)


def weigh(hits: Iterable[int], shares: list[dict[str, float]], rarity: Sequence[float]) -> dict[str, float]:
    """Weight of each subject in a sentence: shares of its terms times their rarity."""
    out: dict[str, float] = {}
    for k in hits:
        for subject, share in shares[k].items():
            out[subject] = out.get(subject, 0.0) + share * rarity[k]
    return out


def subject_sentences(lines: Iterable[Iterable[int]], shares: list[dict[str, float]], rarity: Sequence[float], floor: float) -> dict[str, float]:
    """Sentences of each subject: a sentence counts for its heaviest subject, in part for others that weigh like it."""
    total: dict[str, float] = {}
    for hits in lines:
        weights = weigh(hits, shares, rarity)
        top = max(weights.values())
        if top < floor:
            continue
        own = {k: w for k, w in weights.items() if w >= 0.5 * top}
        scale = sum(own.values())
        for k, w in own.items():
            total[k] = total.get(k, 0.0) + w / scale
    return total


def areas_of(total: dict[str, float], sentences_: int, limits: Thresholds) -> list[str]:
    """The subjects beyond the thresholds; of many subjects, none of which is, the first in order of their sentences;
    ``general`` if all are too few among the text's sentences."""
    n = sum(total.values())
    heard = {k: w for k, w in total.items() if w >= limits.cover * sentences_}
    found = sorted(k for k, w in heard.items() if w >= limits.share * n)
    if not found and heard:
        found = [min(heard, key=lambda k: (-heard[k], k))]
    return found or [GENERAL]


def seed_terms() -> dict[str, dict[str, float]]:
    return {normal(t).strip(): {subject: 1.0} for subject, listed in SEEDS.items() for t in listed.split(", ")}


def labelled_documents(documents: DataFrame, labels: DataFrame, record_id: str, text: str, area: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``id, areas, lines, held``: labelled documents with their normalised sentences; one in ``HELD_OUT`` is held back.

    At most ``max_labelled`` take part (those of the smallest id hash). Labels repeated for a document count once. Null
    ids, areas and texts are left out.
    """
    wanted = labels.select(F.col(f"`{record_id}`").alias("id"), F.col(f"`{area}`").alias("area")).na.drop().distinct().groupBy("id").agg(F.sort_array(F.collect_set("area")).alias("areas"))
    wanted = wanted.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = documents.select(F.col(f"`{record_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["lines"] = [[normal(s) for s in sentences(t)] for t in frame.pop("text")]
            yield frame

    rows = texts.join(wanted, "id").select("id", "areas", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(HELD_OUT)).alias("held"), "text")
    return materialize(rows.mapInPandas(lines, "id long, areas array<string>, held long, lines array<string>").withColumn("held", F.col("held") == 0))


def fit_lexicon(rows: DataFrame) -> Lexicon:
    """The lexicon of ``labelled_documents`` that aren't held back.

    Counting runs on Spark, the driver gets the terms and phrases kept, whose number the labelled documents bound.
    Several subjects of a document share its weight. Without labels the seed terms remain.
    """
    rows = rows.where("not held")
    total = rows.count()
    if total == 0:
        return Lexicon(seed_terms(), ())

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: Counter = Counter()
        for frame in frames:
            for areas, own in zip(frame["areas"], frame["lines"]):
                found: set[str] = set()
                for line in own:
                    found |= terms_of(line)
                for a in (*areas, ""):  # "": documents with the term, whatever their subjects
                    count.update((t, a) for t in found)
                if len(count) > COUNTED:
                    yield _counted(count, "term", "area")
                    count.clear()
        yield _counted(count, "term", "area")

    counted = rows.select("areas", "lines").mapInPandas(lines, "term string, area string, docs long").groupBy("term", "area").agg(F.sum("docs").alias("docs"))
    by_term = counted.groupBy("term").agg(F.max(F.when(F.col("area") == "", F.col("docs"))).alias("n"), F.collect_list(F.when((F.col("area") != "") & (F.col("area") != GENERAL), F.struct("docs", "area"))).alias("by"))
    by_term = materialize(by_term.where((F.col("n") >= MIN_DOCUMENTS) & (F.size("by") > 0)).withColumn("top", F.array_max("by")))
    prior = {r["area"]: (r["n"] + 1) / (total + 2) for r in rows.select(F.explode("areas").alias("area")).groupBy("area").agg(F.count("*").alias("n")).collect()}  # one row for each subject
    expected = F.coalesce(*[F.when(F.col("top.area") == a, F.lit(p)) for a, p in sorted(prior.items())], F.lit(0.5))
    agreed = F.least(F.lit(1 - 1e-9), F.col("top.docs") / F.col("n"))
    surprise = F.col("n") * (agreed * F.log(agreed / expected) + (1 - agreed) * F.log((1 - agreed) / (1 - expected)))
    candidates = max(2, by_term.count())
    terms = seed_terms()
    for r in by_term.where((agreed >= MIN_AGREEMENT) & (agreed > expected) & (surprise >= math.log(candidates))).collect():
        terms[r["term"]] = {x["area"]: x["docs"] / r["n"] for x in r["by"] if x["docs"] / r["n"] >= 0.25}
    terms = _drop_common(terms)
    return Lexicon(terms, _fit_passing(rows, terms))


def _counted(count: Counter, *names: str) -> pd.DataFrame:
    return pd.DataFrame([(*k, n) for k, n in count.items()], columns=[*names, "docs"])


def _drop_common(terms: dict[str, dict[str, float]]) -> dict[str, dict[str, float]]:
    """Without terms that merely extend another one of the same subject (their part says as much)."""
    first = {t: max(shares, key=lambda k: (shares[k], k)) for t, shares in terms.items()}
    out = {}
    for term, shares in terms.items():
        top = first[term]
        inner = (p for p in _parts(term) if p != term)
        if not any(first.get(p) == top and terms[p][top] >= 0.9 * shares[top] for p in inner):
            out[term] = shares
    return out


def _fit_passing(rows: DataFrame, terms: dict[str, dict[str, float]]) -> tuple[str, ...]:
    """Phrases of sentences whose subject is, document by document, none of the labelled ones."""
    dumped = Lexicon(terms, ()).dumps()

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match = matcher(dumped)
        even = [1.0] * len(match.shares)
        count: Counter = Counter()
        for frame in frames:
            for areas, own in zip(frame["areas"], frame["lines"]):
                seen: dict[str, bool] = {}
                for line in own:
                    weights = weigh(match.hits(line), match.shares, even)
                    if weights:
                        off = max(weights, key=lambda k: (weights[k], k)) not in areas
                        for p in phrases_of(line):
                            seen[p] = seen.get(p, False) or off
                count.update((p, str(off)) for p, off in seen.items())
                if len(count) > COUNTED:
                    yield _counted(count, "phrase", "off")
                    count.clear()
        yield _counted(count, "phrase", "off")

    counted = rows.select("areas", "lines").mapInPandas(lines, "phrase string, off string, docs long").groupBy("phrase").agg(F.sum(F.when(F.col("off") == "True", F.col("docs")).otherwise(0)).alias("off"), F.sum("docs").alias("docs"))
    kept = counted.where((F.col("docs") >= PASSING_DOCUMENTS) & (F.col("off") >= PASSING_SHARE * F.col("docs")))
    return tuple(sorted(r["phrase"] for r in kept.collect() if not any(w in terms for w in _parts(r["phrase"]))))


def _parts(phrase: str) -> list[str]:
    words = phrase.split()
    return [" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]


def find_terms(documents: DataFrame, record_id: str, text: str, lexicon: Lexicon) -> DataFrame:
    """``id, n, lines``: of each document with a text that isn't blank its number of sentences and the terms of those
    that have any. One pass of the automaton over the whole texts, without a shuffle; written to the shared folder."""
    dumped = lexicon.dumps()
    rows = documents.select(F.col(f"`{record_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike(r"\S"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match = matcher(dumped)
        for frame in frames:
            out = []
            for i, t in zip(frame["id"], frame["text"]):
                if not t.isspace():
                    own = sentences(t)
                    out.append((i, len(own), [h for h in (match.hits(normal(s)) for s in own) if h]))
            yield pd.DataFrame(out, columns=["id", "n", "lines"])

    return materialize(rows.mapInPandas(run, "id long, n int, lines array<array<int>>"))


def rarities(hits: DataFrame, terms: int) -> list[float]:
    """Rarity of each term, 0 to 1 (in one document of a thousand or fewer), by the share of the whole corpus that has it;
    counts are combined before the shuffle and one number a term reaches the driver."""
    total = hits.count()
    docs = hits.select(F.explode(F.array_distinct(F.flatten("lines"))).alias("k")).groupBy("k").agg(F.count("*").alias("docs")).collect()
    out = [1.0] * terms
    for r in docs:
        out[r["k"]] = min(1.0, math.log(1 + total / r["docs"]) / math.log(1 + 1_000))
    return out


#: Thresholds that are tried.
FLOORS, SHARES, COVERS = (0.05, 0.35, 0.5, 0.6), (0.2, 0.25, 0.3, 0.35), (0.0, 0.05, 0.1)


def calibrate(hits: DataFrame, labelled: DataFrame, shares: list[dict[str, float]], rarity: list[float]) -> Thresholds:
    """The thresholds whose areas agree best (F1) with the labels of the documents held back from the fit."""
    rows = hits.join(small(labelled.where("held").select("id", "areas")), "id").select("n", "lines", "areas")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: Counter = Counter()
        for frame in frames:
            for n, lines, areas in zip(frame["n"], frame["lines"], frame["areas"]):
                truth = set(areas)
                for f in FLOORS:
                    total = subject_sentences(lines, shares, rarity, f)
                    for s in SHARES:
                        for c in COVERS:
                            got = areas_of(total, n, Thresholds(s, c, f))
                            out[s, c, f, "hit"] += len(truth.intersection(got))
                            out[s, c, f, "all"] += len(got) + len(truth)
        yield pd.DataFrame([(*k, v) for k, v in out.items()], columns=["share", "cover", "floor", "what", "n"])

    sums = rows.mapInPandas(score, "share double, cover double, floor double, what string, n long").groupBy("share", "cover", "floor").pivot("what", ["hit", "all"]).sum("n").collect()
    f1 = {(r["share"], r["cover"], r["floor"]): 2 * r["hit"] / max(1, r["all"]) for r in sums}
    if not f1:
        return Thresholds(0.3, 0.0, 0.05)
    # labels are too noisy to tell those apart that are nearly as good: the strictest of them
    return Thresholds(*max(k for k, v in f1.items() if v >= max(f1.values()) - 0.0005))


def assign_subjects(documents: DataFrame, labels: DataFrame, record_id: str, text: str, area: str) -> DataFrame:
    """``record_id, areas``: the subjects of each document, by a lexicon fitted to the labels.

    A text on no subject gets ``general``; null, empty and blank texts get no row. Repeated rows come repeatedly. Null
    ids stay. Without labels the seed terms and default thresholds decide.
    """
    labelled = labelled_documents(documents, labels, record_id, text, area)
    lexicon = fit_lexicon(labelled)
    hits = find_terms(documents, record_id, text, lexicon)
    shares = [lexicon.terms[t] for t in sorted(lexicon.terms)]
    rarity = rarities(hits, len(shares))
    limits = calibrate(hits, labelled, shares, rarity)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            areas = [areas_of(subject_sentences(lines, shares, rarity, limits.floor), n, limits) for n, lines in zip(frame["n"], frame["lines"])]
            yield pd.DataFrame({"id": frame["id"].astype("Int64"), "areas": areas})

    return hits.mapInPandas(run, "id long, areas array<string>").withColumnRenamed("id", record_id)
