"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its labelled texts. A text is cut,
left to right, into the longest pieces that occur in that sample, each with the letter that ended it;
the fewer pieces a text needs for its letters, the nearer it is to the language. With samples of n
characters, pieces * log2(n) / characters estimates the cross entropy, by which languages are compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import kept, small_batches, table

#: Labelled documents per language that the model learns from at most; whole texts, if there are any of so many characters at most then those.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 24, 2000
#: Texts are parsed in blocks of so many characters side by side.
BLOCK = 512
#: Blocks up to which it is quicker to go through them one by one than step by step side by side.
FEW = 32
#: The most frequent letters, whose transitions stand in a table; those of all others are looked up by key.
LETTERS = 62

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, its lower-case letter, or 0 where it is none."""
    if not _LETTER:
        low = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                low[i] = ord(c.lower()[0])
        _LETTER.append(low)
    return _LETTER[0]


def _folded(text: str) -> np.ndarray:
    """Lower-case letters, everything else 0, runs of it joined."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes[(codes != 0) | np.append(codes[1:] != 0, False)]


def _transitions(symbols: np.ndarray) -> list[dict[int, int]]:
    """The suffix automaton: for each state, symbol -> state where a substring goes on."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return to


def suffix_automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Transitions [state, symbol] -> state, 0 (the root) where no substring goes on."""
    to = _transitions(symbols)
    out = np.zeros((len(to), alphabet), np.int32)
    for s, edges in enumerate(to):
        for c, t in edges.items():
            out[s, c] = t
    return out


class Model:
    """The automata of all languages, built once per worker from the sample."""

    def __init__(self, sample: dict[str, str]):
        self.names = sorted(sample)
        texts = [_folded(sample[k]) for k in self.names]
        seen, counts = np.unique(np.concatenate(texts), return_counts=True)
        known = [int(x) for x in seen[np.lexsort((seen, -counts))] if x]
        # 0 is no letter, LETTERS + 1 one that no sample has, above it are those that the tables leave out
        self.alphabet = LETTERS + 2
        self.code = np.full(0x110000, LETTERS + 1, np.int32)
        self.code[0] = 0
        codes = np.arange(1, len(known) + 1)
        self.code[known] = codes + (codes > LETTERS)
        self.width = len(known) + 2
        self.tables, self.rare, self.bits = [], [], []
        for t in texts:
            to = _transitions(self.code[t])
            table, rare = np.zeros((len(to), self.alphabet), np.int32), {}
            for s, edges in enumerate(to):
                for c, x in edges.items():
                    if c < self.alphabet:
                        table[s, c] = x * self.alphabet
                    else:
                        rare[s * self.width + c] = x * self.alphabet
            keys = np.array(sorted(rare), np.int64)
            self.tables.append(table.ravel())
            # a last key that nothing equals, so that what is searched for always has a place
            self.rare.append((np.append(keys, -1), np.array([*(rare[k] for k in keys.tolist()), 0], np.int32)))
            self.bits.append(np.log2(max(2, len(t))))

    @classmethod
    def of(cls, sample: dict[str, str]) -> Model:
        return kept(("language", hash(tuple(sorted(sample.items())))), lambda: cls(sample))

    def _step(self, k: int, state: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
        """States after one more symbol each; the root where the run is known no longer. wide: some symbols may be beyond the table."""
        if not wide:
            return self.tables[k][state + c]
        keys, targets = self.rare[k]
        s = self.tables[k][state + np.minimum(c, LETTERS + 1)]
        at = np.flatnonzero(c >= self.alphabet)
        if len(at):
            key = state[at] // self.alphabet * np.int64(self.width) + c[at]
            place = np.searchsorted(keys[:-1], key)
            s[at] = np.where(keys[place] == key, targets[place], 0)
        return s

    def _from_root(self, k: int, blocks: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All blocks parsed as if a piece began with each: pieces ended in each, the state at its end, and where pieces ended [place, block]."""
        n = len(blocks.owner)
        state, count, cuts = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros((BLOCK, n), bool)
        for i, m in enumerate(blocks.live):
            if not m:
                break
            state[:m] = s = self._step(k, state[:m], blocks.longest_first[i, :m], blocks.wide[i])
            cuts[i, :m] = cut = s == 0
            count[:m] += cut
        back = np.argsort(blocks.order)
        return count[back], state[back], cuts[:, back]

    def _again(self, k: int, blocks: Blocks, which: np.ndarray, state: np.ndarray, before: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for blocks `which` parsed from the states given; where a piece ends in this parse and the one before, they are one from there on."""
        n, state = len(which), state.copy()
        if n <= FEW:
            each = [self._one_again(k, blocks, j, s, before) for j, s in zip(which.tolist(), state.tolist(), strict=True)]
            count, last, cuts = zip(*each, strict=True)
            return np.array(count, np.int32), np.array(last, np.int32), np.stack(cuts, axis=1)
        count, last, passed, cuts = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros((BLOCK, n), bool)
        go = np.arange(n)
        for i in range(BLOCK):
            go = go[blocks.ends[which[go]] > i]
            if not len(go):
                break
            state[go] = s = self._step(k, state[go], blocks.symbols[i, which[go]], blocks.wide[i])
            cuts[i, go] = s == 0
            count[go] += s == 0
            last[go] = s
            was = before[2][i, which[go]]
            passed[go] += was
            both = was & (s == 0)
            if both.any():
                met = go[both]
                count[met] += before[0][which[met]] - passed[met]
                last[met] = before[1][which[met]]
                cuts[i + 1 :, met] = before[2][i + 1 :, which[met]]
                go = go[~both]
        return count, last, cuts

    def _one_again(self, k: int, blocks: Blocks, j: int, state: int, before: tuple) -> tuple[int, int, np.ndarray]:
        """_again for one block, symbol by symbol."""
        to, (keys, targets) = memoryview(self.tables[k]), self.rare[k]
        was, cuts, count, passed = before[2][:, j], np.zeros(BLOCK, bool), 0, 0
        for i, (c, cut) in enumerate(zip(blocks.symbols[: blocks.ends[j], j].tolist(), was.tolist(), strict=False)):
            passed += cut
            if c < self.alphabet:
                state = to[state + c]
            else:
                key = state // self.alphabet * self.width + c
                place = int(np.searchsorted(keys[:-1], key))
                state = int(targets[place]) if keys[place] == key else 0
            if state == 0:
                count, cuts[i] = count + 1, True
                if cut:
                    cuts[i + 1 :] = was[i + 1 :]
                    return count + int(before[0][j]) - passed, int(before[1][j]), cuts
        return count, state, cuts

    def pieces(self, texts: list[np.ndarray]) -> np.ndarray:
        """Pieces that each text of symbols needs [text, language], by longest matches from its start to its end.

        All blocks of all texts are parsed at once as if a piece began with each. Then each is parsed again
        from the state in which the one before it ended, until a piece ends in both parses; blocks whose
        predecessor thereby ends otherwise are parsed once more, until nothing changes.
        """
        blocks = Blocks(texts, self.alphabet)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        if not len(blocks.owner):
            return out
        follows = np.flatnonzero(blocks.owner[1:] == blocks.owner[:-1]) + 1
        for k in range(len(self.names)):
            count, last, cuts = self._from_root(k, blocks)
            due = follows[last[follows - 1] != 0]  # where nothing is left open before a block, its parse from the root stands
            while len(due):
                was = last[due].copy()
                got = self._again(k, blocks, due, last[due - 1], (count, last, cuts))
                count[due], last[due], cuts[:, due] = got
                changed = due[last[due] != was]
                due = changed[np.isin(changed + 1, follows)] + 1
            end = np.append(blocks.owner[1:] != blocks.owner[:-1], True)
            out[:, k] = np.bincount(blocks.owner, count + (end & (last != 0)), len(texts))
        return out

    def rates(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character [text, language], and the number of letters of each text."""
        folded = [self.code[_folded(t or "")] for t in texts]
        sizes = np.array([len(x) for x in folded])
        letters = np.array([np.count_nonzero(x) for x in folded])
        pieces = self.pieces(folded)
        return pieces * np.array(self.bits) / np.maximum(sizes, 1)[:, None], letters


class Blocks:
    """Texts of symbols cut into blocks [place, block], the text of each block, and how long it is; the same with the longest first."""

    def __init__(self, texts: list[np.ndarray], alphabet: int):
        sizes = np.array([len(x) for x in texts], np.int64)
        blocks = -(-sizes // BLOCK)
        self.owner = np.repeat(np.arange(len(texts)), blocks)
        most = max((int(x.max(initial=0)) for x in texts), default=0)
        grid, self.ends, row = np.zeros((len(self.owner), BLOCK), np.min_scalar_type(most)), np.full(len(self.owner), BLOCK), 0  # a byte a symbol, but for rare letters
        flat = grid.ravel()
        for x, n, b in zip(texts, sizes.tolist(), blocks.tolist(), strict=True):
            flat[row * BLOCK : row * BLOCK + n] = x
            row += b
            if b:
                self.ends[row - 1] = n - (b - 1) * BLOCK
        self.symbols = np.ascontiguousarray(grid.T)
        self.wide = self.symbols.max(axis=1, initial=0) >= alphabet
        self.order = np.argsort(-self.ends, kind="stable")
        self.longest_first = self.symbols[:, self.order]
        self.live = np.searchsorted(-self.ends[self.order], -np.arange(BLOCK), side="left")  # blocks of more symbols than so many


def sample(labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS, characters: int = SAMPLE_CHARACTERS) -> dict[str, str]:
    """For each label, `documents` of its different texts, whole, chosen by the texts' hashes; those of at most `characters` characters first, of longer ones the shortest."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("text").alias("h"), F.greatest(F.length("text"), F.lit(characters)).alias("size"), "text")
    few = rows.select("lang", "size", "h").distinct()
    # best of each of 64 parts first, so that no task holds a whole language
    for keys in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        few = few.withColumn("nth", F.row_number().over(W.partitionBy(*keys).orderBy("size", "h"))).filter(F.col("nth") <= documents).drop("nth")
    got: dict[str, list] = {}
    for r in rows.join(F.broadcast(few.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).collect():
        got.setdefault(r["lang"], []).append((r["h"], r["text"]))
    return {k: "\n".join(t for _, t in sorted(v)) for k, v in got.items()}


def identified(learnt: dict[str, str]):
    """A function of a text column to a struct of lang_pred, score, bits (a character, of the best language) and letters.

    score is the share by which the best language's rate is below the next one's, from 0 to 1. Null or
    empty texts, and those without a letter, are `und` with score 0; so is every text when nothing could
    be learnt. Ties go to the label that sorts first. Whole texts are parsed, however long.
    """

    @F.pandas_udf("lang_pred string, score double, bits double, letters bigint")
    def run(text: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": ["und"] * len(text), "score": 0.0, "bits": 0.0, "letters": 0})
        if not learnt or not len(text):
            return out
        model = Model.of(learnt)
        rates, letters = model.rates([t if isinstance(t, str) else None for t in text])
        two, good = np.sort(rates, axis=1), letters > 0
        score = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-9) if rates.shape[1] > 1 else np.ones(len(text))
        out["lang_pred"] = np.where(good, np.array(model.names, object)[rates.argmin(axis=1)], "und")
        out["score"] = np.where(good, np.clip(score, 0, 1), 0.0)
        out["bits"], out["letters"] = np.where(good, two[:, 0], 0.0), letters
        return out

    return run


def learn(docs: DataFrame) -> dict[str, str]:
    """The sample of all documents that are not held out."""
    return sample(docs.filter(~held_out()))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits, letters, for every row; extra columns are left behind."""
    small_batches(docs.sparkSession, 4)
    named = docs.select("doc_id", held_out().alias("held_out"), identified(learn(docs))("text").alias("x"))
    return named.select("doc_id", "held_out", "x.lang_pred", "x.score", "x.bits", "x.letters")


#: Bits a letter with which letters drawn at random would be told; no language needs so many.
RANDOM_BITS = 4.7
#: Letters from which a text's bits are told from those of random letters; below, a piece or two too many decide.
TELLING_LETTERS = 64


def in_a_language(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns kept, but those without a letter and longer ones that parse no better than random letters."""
    small_batches(docs.sparkSession, 4)
    x = identified(learn(docs))("text")
    return docs.filter((x["lang_pred"] != "und") & ((x["bits"] < RANDOM_BITS) | (x["letters"] < TELLING_LETTERS)))


def held_out():
    """Whether a row is kept from learning: by the CRC of its doc_id as text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
