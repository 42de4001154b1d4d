"""Language posteriors of texts by naive Bayes over character n-grams, a batch of texts at a time."""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import KEY_SPACE, random_key

#: Labelled documents that the model is fitted on.
FIT_DOCS = 3000
#: Buckets of hashed character n-grams, and the share of the uniform distribution that each language's is mixed with, so
#: that an n-gram unknown to several languages counts alike in all.
BUCKETS, UNIFORM = 1 << 17, 0.02
#: Nats by which another language must be likelier: a character n-gram, so that names and a leading topic don't decide, and in all.
MARGIN, ODDS = 0.25, 9.0
#: A script that makes up less than this share of the labelled letters is one of a language without labelled documents.
KNOWN_SHARE = 1e-3
#: Characters scored together.
CHUNK = 400_000


#: Code points from here on hold no letters.
LAST = 0x32000


def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its lower-case form (0 for what is no letter), whether it is a capital, and the number of its script.

    The script is the first word of the character's Unicode name (CJK, HANGUL, CYRILLIC, ...); letters beyond the basic plane have 0.
    """
    lower, capital, script, names = np.zeros(LAST, np.uint32), np.zeros(LAST, bool), np.zeros(LAST, np.int16), {}
    for c in range(LAST):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            lower[c] = ord(ch.lower()[0])
            capital[c] = ch.isupper() or ch.istitle()
            if c < 0x10000:
                script[c] = names.setdefault(unicodedata.name(ch, "NONE").split(" ", 1)[0], len(names) + 1)
    return lower, capital, script


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), np.uint32(LAST - 1))


class Languages:
    """Naive Bayes over hashed character unigrams and bigrams of letters, one class a label.

    Letters of scripts that the labelled texts lack are classes too: uniform over the letters of the script.
    """

    def __init__(self, names: list[str], logs: np.ndarray, known: np.ndarray, tables: tuple[np.ndarray, ...]):
        self.names, self.logs, self.known, self.tables = names, np.ascontiguousarray(logs, np.float32), known, tables
        sizes = np.bincount(tables[2], minlength=len(known))
        self.uniform = -np.log(np.maximum(sizes, 1))

    @staticmethod
    def features(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the unigram at each letter and of the bigram at each place but the last."""

        def bucket(x: np.ndarray) -> np.ndarray:
            return ((x ^ (x >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64)

        return bucket(code * np.uint32(0x9E3779B1)), bucket((code[:-1] * np.uint32(0x85EBCA77) + code[1:]) * np.uint32(0xC2B2AE3D))

    @staticmethod
    def letters(texts: list[str], tables: tuple[np.ndarray, ...], names_too: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, original code, text number) of the letters in lower case; a run of other characters is one 0, and each text ends with one.

        Without ``names_too``, words that begin with a capital are left out.
        """
        lower, capital, _ = tables
        raw = _codes("\n".join(texts) + "\n")
        lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        owner = np.repeat(np.arange(len(texts)), lens)
        code = lower[raw]
        if not names_too:
            is_letter = code != 0
            starts = is_letter & ~np.concatenate([[False], is_letter[:-1]])
            word = np.cumsum(starts) - 1
            named = capital[raw[starts]]
            code = np.where(is_letter & named[word] if len(named) else False, np.uint32(0), code)
        gap = code == 0
        keep = ~gap | np.concatenate([[True], ~gap[:-1]])
        keep[np.cumsum(lens) - 1] = True
        return code[keep], raw[keep], owner[keep]

    @classmethod
    def fit(cls, texts: list[str], labels: list[str]) -> Languages:
        names = sorted(set(labels))
        tables = letter_tables()
        script = tables[2]
        seen = np.zeros(int(script.max()) + 1, np.int64)
        label = np.array([names.index(x) for x in labels], np.int64)
        parts = []  # (feature, text number) of chunks of texts
        for at in range(0, len(texts), 200):
            code, raw, owner = cls.letters(texts[at : at + 200], tables)
            one, two = cls.features(code)
            first = code != 0
            second = owner[:-1] == owner[1:]
            seen += np.bincount(script[raw[first]], minlength=len(seen))
            parts += [(one[first], owner[first] + at), (two[second], owner[:-1][second] + at)]
        known = seen >= max(1.0, KNOWN_SHARE * seen.sum())
        logs, keep = np.zeros((BUCKETS, 0), np.float32), np.ones(len(texts), bool)
        for last in (False, True):  # the second time without documents whose label the first model contradicts
            counts = np.zeros(BUCKETS * len(names))
            for feat, who in parts:
                mine = keep[who]
                counts += np.bincount(feat[mine] * len(names) + label[who[mine]], minlength=len(counts))
            counts = counts.reshape(BUCKETS, len(names))
            total = counts.sum(0)
            logs = np.log((1 - UNIFORM) * counts / np.maximum(total, 1) + UNIFORM / BUCKETS).astype(np.float32)
            logs[:, total == 0] = -1e3
            if not last and names:
                sums, some = np.zeros((len(texts), len(names))), np.zeros(len(texts), bool)
                for feat, who in parts:
                    if len(who):
                        starts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
                        sums[who[starts]] += np.add.reduceat(logs[feat], starts, axis=0)
                        some[who[starts]] = True
                keep = some & (sums.argmax(1) == label)
        return cls(names, logs, known, tables)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods of texts, a row each, by language and then by unlabelled script, and the number of n-grams."""
        script = self.tables[2]
        out = np.full((len(texts), len(self.names) + len(self.known)), -np.inf, np.float64)
        grams = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size < CHUNK):
                size += len(texts[stop])
                stop += 1
            code, raw, owner = self.letters(texts[at:stop], self.tables, names_too=False)
            one, two = self.features(code)
            first = code != 0
            second = (owner[:-1] == owner[1:]) & (first[:-1] | first[1:])
            counts = np.zeros(stop - at, np.int64)
            sums = np.zeros((stop - at, len(self.names)))
            n = stop - at
            for feat, who in ((one[first], owner[first]), (two[second], owner[:-1][second])):
                k = np.bincount(who, minlength=n)
                some = np.flatnonzero(k)
                if len(some):
                    sums[some] += np.add.reduceat(self.logs[feat], (np.cumsum(k) - k)[some], axis=0)
                counts += k
            out[at:stop, : len(self.names)] = sums
            foreign = first & ~self.known[script[raw]] & (script[raw] > 0)
            if foreign.any():
                both = foreign[:-1] & second
                k1 = np.zeros((n, len(self.known)), np.int64)
                np.add.at(k1, (owner[foreign], script[raw[foreign]]), 1)
                k2 = np.bincount(owner[:-1][both], minlength=n)
                unseen = np.log(UNIFORM / BUCKETS)
                rows, scripts = np.nonzero(k1)
                inside = k1[rows, scripts] * self.uniform[scripts] - k2[rows] * np.log(BUCKETS)
                out[at + rows, len(self.names) + scripts] = inside + (counts[rows] - k1[rows, scripts] - k2[rows]) * unseen
            grams[at:stop] = counts
            at = stop
        return out, grams

    def differ(self, questions: list[str], answers: list[str]) -> np.ndarray:
        """Whether each answer is in another language than its question, by their posteriors.

        Words with a capital are names or terms and no evidence; a text without any evidence differs from none.
        """
        if not self.names or not questions:
            return np.zeros(len(questions), bool)
        (q, m), (a, n) = self.scores(questions), self.scores(answers)
        rows = np.arange(len(q))
        lq, la = q.argmax(1), a.argmax(1)
        least = lambda k: np.maximum(ODDS, MARGIN * k)
        with np.errstate(invalid="ignore"):
            return (lq != la) & (m > 0) & (n > 0) & (a[rows, la] - a[rows, lq] > least(n)) & (q[rows, lq] - q[rows, la] > least(m))


def fit_languages(docs: DataFrame, limit: int = FIT_DOCS) -> Languages:
    """Language model of a seeded sample of about ``limit`` labelled documents; labels by their first two letters.

    The sample is those whose hash lies below limit / count, so that tasks send only sampled texts to the driver.
    """
    lab = F.substring(F.lower(F.trim("lang")), 1, 2)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 20))
    n = labelled.count()
    u = random_key(5, F.col("doc_id")) / float(KEY_SPACE)
    got = labelled.where(u < limit / max(n, 1)).select("text", F.when(lab == "jp", "ja").otherwise(lab).alias("lab")).limit(2 * limit).collect()
    return Languages.fit([r.text for r in got], [r.lab for r in got])
