"""Language ID for mixed-language text: script ranges, per-word scores, Viterbi.

Learning counts the character trigrams of the words of labelled documents, for
each language, over all of them. The model keeps every one, so neither a small
language nor a large sign inventory loses any to the others, and the scripts
that each language uses. It takes 8 bytes a pair of trigram and language and 16
a trigram, in the driver and in every Python worker.

A word is a stretch of letters of one script: it ends at signs that are no
letters and where the script changes, so text without blanks has words too. Its
script leaves the languages written in it as candidates. Its score for a language
is the sum of the smoothed log probabilities of its trigrams, and Viterbi with a
penalty for each switch gives every word a language; runs of one language are
the text's spans. The document's language is the one whose spans
hold the most letters. Its score is their share of the letters, times the share
of the trigrams that the model knows, so text like no learned language scores
low.

Texts that are null or have no letter are ``und`` with score 0, and so is all
text where nothing was learned. Ties go to the first language in order of its
name. Languages are learned as they are spelled; rows with a null language or
text teach nothing; repeated rows count each time.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import Batches, batch_of, in_batches, stored

SWITCH = 12.0
SMOOTH = 0.5
COUNTED = 100_000  # distinct runs that a task counts before it passes on their trigrams
PART = 200_000  # letters whose trigrams are taken at once
TEXTS = 500_000  # characters of texts that are labelled at once, or a longer text
REMEMBERED = 150_000  # words or runs that a worker remembers
USED = 0.01  # a language is written in a script that has at least this share of its letters
FLOOR = -30.0  # the score of a word for a language that is not written in its script

# First code points of script ranges; "" is everything without a script of its own.
SCRIPTS = (
    (0x0000, ""), (0x0041, "latin"), (0x005B, ""), (0x0061, "latin"), (0x007B, ""), (0x00AA, "latin"), (0x02B0, ""), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"),
    (0x0780, "thaana"), (0x07C0, ""), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, ""), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, ""),
    (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x2C60, "latin"), (0x2C80, ""), (0x2E80, "han"), (0x3040, "kana"),
    (0x3100, "bopomofo"), (0x3130, "hangul"), (0x3190, ""), (0x31F0, "kana"), (0x3200, ""), (0x3400, "han"), (0xA000, ""),
    (0xA640, "cyrillic"), (0xA6A0, ""), (0xA720, "latin"), (0xA800, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, ""), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, ""),
    (0xFF21, "latin"), (0xFF3B, ""), (0xFF41, "latin"), (0xFF5B, ""), (0xFF66, "kana"), (0xFFA0, ""), (0x20000, "han"), (0x32000, ""),
)
STARTS, NAMES = [s for s, _ in SCRIPTS], [n for _, n in SCRIPTS]
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def script_of(word: str) -> str:
    """The script of a word's first letter that has one."""
    return next((name for c in word if (name := NAMES[bisect_right(STARTS, ord(c)) - 1])), "")


def _pieces() -> regex.Pattern:
    """Stretches of one script; signs without a script of their own go with the letters before them."""
    ranges: dict[str, str] = {}
    for start, end, name in zip(STARTS, [*STARTS[1:], 0x110000], NAMES):
        ranges[name] = ranges.get(name, "") + f"\\U{start:08X}-\\U{end - 1:08X}"
    neutral = ranges.pop("")
    return regex.compile(f"[{neutral}]*(?:" + "|".join(f"[{own}][{own}{neutral}]*" for own in ranges.values()) + f")|[{neutral}]+")


PIECES = _pieces()


def words_of(run: str) -> list[str]:
    """The words in a run without blanks: letters, cut where the script changes."""
    lowered = run.lower()
    if lowered.isascii():
        return [lowered] if lowered.isalpha() else LETTERS.findall(lowered)
    return [piece for word in LETTERS.findall(lowered) for piece in PIECES.findall(word)]


def in_parts(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """The texts in order, so many at once that all but the last make up at most ``size`` characters."""
    part, held = [], 0
    for text in texts:
        if held > size:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text or "")
    if part:
        yield part


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of ``^word$`` for each word, a number each, and how many each word has: its length."""
    each = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join([f"^{t}$" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    first = np.arange(each.sum()) + np.repeat(2 * np.arange(len(each)), each)  # two more characters a word, where no trigram begins
    return points[first] << 42 | points[first + 1] << 21 | points[first + 2], each


COUNTS = pa.schema([("lang", pa.string()), ("script", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def learned_counts(docs: DataFrame) -> DataFrame:
    """lang, script, gram (one of them null), n over all labelled rows; summed in each task before the shuffle."""
    rows = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches: Batches) -> Batches:
        words: dict[str, Counter] = {}

        def out() -> Batches:
            for lang, found in words.items():
                each, scripts = Counter(), Counter()
                for run, n in found.items():
                    for word in words_of(run):
                        each[word] += n
                        scripts[script_of(word)] += n * len(word)
                k = len(scripts)
                yield batch_of(COUNTS, [[lang] * k, list(scripts), [None] * k, list(scripts.values())])
                for part in in_parts(list(each), PART):
                    codes, lengths = codes_of(part)
                    grams, at = np.unique(codes, return_inverse=True)
                    sums = np.zeros(len(grams), np.int64)
                    np.add.at(sums, at, np.repeat(np.fromiter(map(each.__getitem__, part), np.int64, len(part)), lengths))
                    m = len(grams)
                    yield batch_of(COUNTS, [[lang] * m, [None] * m, grams, sums])
            words.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                words.setdefault(lang, Counter()).update(text.split())
                if sum(map(len, words.values())) > COUNTED:
                    yield from out()
        yield from out()

    return in_batches(rows, run, "lang string, script string, gram long, n long").groupBy("lang", "script", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of every trigram learned.

    ``grams`` are in ascending order; those of place i have their languages and
    weights from ``starts[i]`` to ``starts[i + 1]``. A weight is what a trigram
    adds, in a language that has it, to the log probability of one that was
    never seen in it (``unknown``).
    """

    def __init__(self, langs: list[str], pairs: tuple[np.ndarray, np.ndarray, np.ndarray], scripts: dict[str, np.ndarray]):
        gram, lang, n = pairs
        by = np.argsort(gram, kind="stable")
        gram = gram[by]
        cuts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
        self.langs, self.scripts, self.grams, self.starts = langs, scripts, gram[cuts], np.append(cuts, len(gram))
        self.lang, self.weight = lang[by].astype(np.int32), np.log1p(n[by] / SMOOTH).astype(np.float32)
        size = np.bincount(lang, n, len(langs))
        self.unknown = np.log(SMOOTH / (size + SMOOTH * max(1, len(self.grams))))

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its scores for the languages, its trigrams, and those that are known."""
        codes, each = codes_of(words)
        place = np.minimum(np.searchsorted(self.grams, codes), max(0, len(self.grams) - 1))
        found = self.grams[place] == codes if len(self.grams) else np.zeros(len(codes), bool)
        word, place = np.repeat(np.arange(len(words)), each)[found], place[found]
        lengths = self.starts[place + 1] - self.starts[place]
        at = np.arange(lengths.sum()) + np.repeat(self.starts[place] - (np.cumsum(lengths) - lengths), lengths)
        cell = np.repeat(word, lengths) * len(self.langs) + self.lang[at]
        gained = np.bincount(cell, self.weight[at], len(words) * len(self.langs)).reshape(len(words), len(self.langs))
        return gained + each[:, None] * self.unknown, each, np.bincount(word, minlength=len(words))


def learn(docs: DataFrame) -> Model:
    counts = stored(learned_counts(docs), "language-counts")
    sums = {r.lang: r.n for r in counts.where("gram is not null").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sums)
    place = {lang: i for i, lang in enumerate(langs)}
    places = F.broadcast(docs.sparkSession.createDataFrame(list(place.items()), "lang string, place int"))
    found = counts.where("gram is not null").join(places, "lang").select("gram", "place", "n").toArrow()
    pairs = tuple(found.column(c).to_numpy() for c in ("gram", "place", "n"))
    scripts: dict[str, np.ndarray] = {}
    for row in counts.where("script is not null").collect():
        if row.lang in place and row.n >= USED * sums[row.lang]:
            scripts.setdefault(row.script, np.zeros(len(langs), bool))[place[row.lang]] = True
    return Model(langs, pairs, scripts)


class Labeller:
    """Scores of the words of runs without blanks, remembered for ``REMEMBERED`` words or runs, and the best path through a text."""

    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch = model, switch
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # a run's place in ``ends``
        self.ends = np.zeros(1, np.int64)  # the words of run i: ``rows`` from ends[i] to ends[i + 1]
        self.rows = np.zeros((0, len(self.model.langs)), np.float32)
        self.facts = np.zeros((0, 2), np.int64)  # trigrams (a letter each), trigrams that are known

    def meet(self, texts: list[str | None]) -> list[list[str]]:
        """The runs of some texts; the words of those not known yet are scored together."""
        if max(len(self.known), len(self.rows)) > REMEMBERED:
            self.forget()
        runs = [t.split() if t else [] for t in texts]
        new = list({r for own in runs for r in own if r not in self.known})
        parts = [words_of(run) for run in new]
        flat = [word for words in parts for word in words]
        self.known.update(zip(new, range(len(self.ends) - 1, len(self.ends) - 1 + len(new))))
        self.ends = np.concatenate([self.ends, len(self.rows) + np.cumsum([len(words) for words in parts], dtype=np.int64)])
        if flat:
            rows, each, hits = self.scored(flat)
            rows = rows.astype(np.float32)
            scripts = np.array(["latin" if word[0] < "\u02b0" else script_of(word) for word in flat])
            for script, written in self.model.scripts.items():
                if not written.all():
                    rows[np.ix_(scripts == script, ~written)] += FLOOR
            self.rows = np.concatenate([self.rows, rows])
            self.facts = np.concatenate([self.facts, np.stack([each, hits], axis=1)])
        return runs

    def scored(self, words: list[str]) -> list[np.ndarray]:
        """The model's scores of words, taken in parts of some letters."""
        return [np.concatenate(x) for x in zip(*map(self.model.scores, in_parts(words, PART)))]

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The best sequence of languages.

        Let one language be best overall. A path that leaves it gains, by each
        stretch in another language, at most the largest gain of any stretch,
        and pays a switch for each (one more for stretches inside); a path
        without it gains its first and last stretch and pays one switch less.
        Where no stretch gains more than a switch, and none at the start and
        none at the end together more than one, staying is best.
        """
        best = int(scores.sum(axis=0, dtype=np.float64).argmax())
        gain = np.cumsum(scores.astype(np.float64) - scores[:, [best]], axis=0)
        lowest = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
        inside = max(gain.max(), (gain[1:] - lowest[:-1]).max(initial=0.0))
        last = (gain[-1] - lowest[:-1].min(axis=0, initial=0.0)).max() if len(gain) > 1 else 0.0
        if inside <= self.switch and max(0.0, gain.max()) + max(0.0, last) <= self.switch:
            return np.full(len(scores), best)
        langs = range(scores.shape[1])
        value, back = scores[0].tolist(), []
        for row in scores[1:].tolist():
            most = max(value)
            top, switched = value.index(most), most - self.switch
            back.append([k if value[k] >= switched else top for k in langs])
            value = [max(value[k], switched) + row[k] for k in langs]
        out = [value.index(max(value))]
        for step in reversed(back):
            out.append(step[out[-1]])
        return np.array(out[::-1], np.int64)

    def places(self, runs: list[str]) -> np.ndarray:
        """The rows of the runs' words, in order."""
        at = np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))
        first, counts = self.ends[at], self.ends[at + 1] - self.ends[at]
        return np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) over the words of the text."""
        places = self.places(self.meet([text])[0])
        if not len(places) or not self.model.langs:
            return []
        path = self.path(self.rows[places])
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        return [(a, b, self.model.langs[path[a]]) for a, b in zip(cuts, cuts[1:])]

    def label(self, runs: list[str]) -> tuple[str, float]:
        places = self.places(runs)
        if not len(places) or not self.model.langs:
            return "und", 0.0
        path, facts = self.path(self.rows[places]), self.facts[places]
        letters = np.bincount(path, facts[:, 0], len(self.model.langs))
        best = int(letters.argmax())
        return self.model.langs[best], float(letters[best] / letters.sum() * facts[:, 1].sum() / facts[:, 0].sum())

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return [self.label(runs) for part in in_parts(texts, TEXTS) for runs in self.meet(part)]


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns with lang_pred and score; the text alone is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    kinds = [f"`{c}` {t}" for c, t in rows.dtypes if c in keep]

    def run(batches: Batches) -> Batches:
        own = Labeller(shared.value)
        for batch in batches:
            found = own(batch.column(len(keep)).to_pylist())
            langs, scores = (pa.array([f[i] for f in found], t) for i, t in ((0, pa.string()), (1, pa.float64())))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], langs, scores], names=[*keep, "lang_pred", "score"])

    return in_batches(rows, run, ", ".join([*kinds, "lang_pred string, score double"]))
