"""Mapping free-entered values to a canonical list: a trie of reference entries and their alias paths, searched with a Levenshtein automaton.

The trie holds every entry under its folded full name and under alias paths: without joining words, abbreviated as journals
are, inverted ("Topic, Kind of"), and, as entries of their own without an id, the combinations of a kind and a topic of the list that
are not on the list, so that a value that means one of those isn't pulled to a neighbour. The automaton is the bit-parallel
simulation of the Levenshtein automaton; it is moved along the trie's edges and prunes every branch whose states have died, and returns all entries
within a distance that depends on the value's length. The nearest wins; if entries of different ids are as near, none does.

Cases: null and blank values have no result; a value that equals an entry character for character has none either unless
asked for; values of any length are searched whole (what is much longer than every entry dies early); the list is read once and must
stay under a stated number of entries; repeated entries count once.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.names import near

#: The list is sent to every executor; a longer one is refused.
MOST_ENTRIES = 100_000
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοАВЕКМНОРСТХ", "aeopcyxijsdhlABEZHIKMNOPTYXaoABEKMHOPCTX")
JOINING = {"of", "in", "on", "and", "the", "for"}
#: Usual abbreviations of kinds of publication.
KINDS = {
    "advances": "adv", "annals": "ann", "bulletin": "bull", "international": "int", "conference": "conf", "journal": "j",
    "letters": "lett", "proceedings": "proc", "symposium": "symp", "reviews": "rev", "transactions": "trans", "workshop": "wksp",
}
MARK = re.compile(r"\s*(…|\.\.\.)\s*$")


def fold(text: str) -> str:
    """Lower case without accents, look-alikes, entities, punctuation or doubled spaces; & is and."""
    text = unicodedata.normalize("NFKD", html.unescape(text).translate(LOOKALIKES))
    text = "".join(c for c in text if not unicodedata.combining(c)).lower().replace("&", " and ")
    return " ".join(re.sub(r"[^a-z0-9,:()]+", " ", text).split())


def budget(length: int) -> int:
    """Edits that a value of so many characters may have."""
    return 0 if length < 6 else 1 if length < 10 else 2 if length < 18 else 4 if length < 36 else 5


class Trie:
    """Nodes are dicts by character; ids that end at a node are under the empty string."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, text: str, what: int) -> None:
        node = self.root
        for c in text:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add(what)

    def exact(self, text: str) -> set[int]:
        node = self.root
        for c in text:
            node = node.get(c)
            if node is None:
                return set()
        return node.get("", set())

    def near(self, text: str, most: int, prefix: bool = False) -> dict[int, int]:
        """Every id within most edits of text, with its least distance; with prefix, of entries that go on after it."""
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        last, found = 1 << len(text), {}
        # Bit i of rows[d]: i characters of text are read with at most d edits.
        start = [(1 << (d + 1)) - 1 for d in range(most + 1)]
        stack = [(self.root, start)]
        while stack:
            node, rows = stack.pop()
            if rows[most] & last:
                d = next(d for d in range(most + 1) if rows[d] & last)
                ids = [(d, x) for x in node.get("", ())]
                if prefix:
                    ids = [(d, x) for x in self.below(node)]
                for d, x in ids:
                    if d < found.get(x, most + 1):
                        found[x] = d
                if prefix and d == 0:
                    continue
            for c, child in node.items():
                if c:
                    m, new, before = masks.get(c, 0), [], 0
                    for d in range(most + 1):
                        row = (rows[d] & m) << 1
                        if d:
                            row |= rows[d - 1] | rows[d - 1] << 1 | before << 1
                        new.append(row)
                        before = row
                    if new[most]:
                        stack.append((child, new))
        return found

    @staticmethod
    def below(node: dict) -> set[int]:
        out, stack = set(), [node]
        while stack:
            x = stack.pop()
            for c, child in x.items():
                if c:
                    stack.append(child)
                else:
                    out |= child
        return out


class Matcher:
    """Entries with ids above 0; combinations that are not on the list have id 0."""

    def __init__(self, entries: list[tuple[int, str]], affixes: list[str]):
        self.full, self.alias = Trie(), Trie()
        self.affixes = sorted({fold(x) for x in affixes if x}, key=len, reverse=True)
        names: dict[str, int] = {}
        for what, name in sorted(entries):
            names.setdefault(fold(name), what)
        parts = [self.split(x) for x in names]
        kinds, topics = {k for k, _ in parts if k}, {t for k, t in parts if k}
        # Combinations that are not on the list are entries too where there aren't many more of them than entries; else they are compared when a value comes near an entry.
        self.pairs: dict[int, list[tuple[str, str]]] = {}
        self.kinds, self.topics, self.topic_names, self.listed = sorted(kinds), Trie(), sorted(topics), set(names)
        if len(kinds) * len(topics) <= 20 * len(names):
            for k in kinds:
                for t in topics:
                    names.setdefault(f"{k} {t}", 0)
        else:
            for name, (k, t) in zip(list(names), parts):
                if k:
                    self.pairs.setdefault(names[name], []).append((k, t))
            for i, t in enumerate(self.topic_names):
                self.topics.add(t, i)
        for name, what in names.items():
            self.full.add(name, what)
            self.full.add(self.without(name), what)
            kind, topic = self.split(name)
            if kind:
                self.full.add(f"{topic}, {kind}", what)
            for n in (4, 5, 6):
                self.alias.add(self.short(name, n), what)
        self.known: dict[str, int] = {}

    @staticmethod
    def split(name: str) -> tuple[str, str]:
        """Kind, with the joining words after it, and topic."""
        words = name.split()
        last = max((i for i, w in enumerate(words[:6]) if w in KINDS), default=-1)
        if last < 0:
            return "", name
        while last + 1 < len(words) - 1 and words[last + 1] in JOINING:
            last += 1
        return " ".join(words[: last + 1]), " ".join(words[last + 1 :])

    @staticmethod
    def without(name: str) -> str:
        return " ".join(w for w in name.split() if w not in JOINING - {"and"})

    @staticmethod
    def short(name: str, n: int) -> str:
        return " ".join(KINDS.get(w, w if len(w) <= n + 1 else w[:n]) for w in name.split() if w not in JOINING)

    def forms(self, value: str) -> list[str]:
        """The folded value, then without what surrounds names: years, volumes, acronyms, publishers, an article."""
        x = re.sub(r"\([^()]*\)$", "", value).strip()
        x = re.sub(r"^(19|20)\d\d\b[\s,:]*", "", x)
        x = re.sub(r"[\s,]*\b(vol(ume)?|no|issue|pp?)?\s*\d+\s*(\(\d+\))?(\s*,?\s*(pp?)?\s*\d+( \d+)?)?$", "", x).strip(" ,:")
        for a in self.affixes:
            x = re.sub(rf"^{re.escape(a)}\s*[:,]\s*|\s*[:,]\s*{re.escape(a)}$", "", x)
        x = re.sub(r"\([^()]*\)$", "", x).strip(" ,:")
        x = re.sub(r"^the ", "", x)
        return list(dict.fromkeys([x, value]))

    def of(self, raw: str) -> int:
        got = self.known.get(raw)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[raw] = self.search(raw)
        return got

    def within(self, raw: str) -> dict[int, int]:
        """All entries within the distance that the value's length allows, each with its least distance; 0 stands for combinations that are not on the list."""
        cut = MARK.search(raw)
        return self.nearest([x for x in self.forms(fold(MARK.sub("", raw) if cut else raw)) if x], bool(cut))

    def nearest(self, forms: list[str], cut: bool) -> dict[int, int]:
        best: dict[int, int] = {}
        for x in forms:
            for ids, extra in ((self.full.near(x, budget(len(x))), 0), (self.full.near(x, min(2, budget(len(x))), True) if cut and len(x) > 7 else {}, 0), (self.alias.near(x, min(1, budget(len(x)))), 0)):
                for what, d in ids.items():
                    best[what] = min(best.get(what, 99), d + extra)
            if best:
                break
        return best

    def search(self, raw: str) -> int:
        cut = MARK.search(raw)
        forms = [x for x in self.forms(fold(MARK.sub("", raw) if cut else raw)) if x]
        for x in forms:
            for ids in (self.full.exact(x), self.alias.exact(re.sub(r"[,:]", " ", x))):
                if len(ids) == 1:
                    return next(iter(ids))
        best = self.nearest(forms, bool(cut))
        least = min(best.values(), default=99)
        ids = [x for x, d in best.items() if d == least]
        if cut and len(ids) > 1:  # several entries begin so: one that is on the list alone
            ids = [x for x in ids if x]
        return ids[0] if len(ids) == 1 and not self.off_list(ids[0], forms, least) else 0

    def off_list(self, what: int, forms: list[str], distance: int) -> bool:
        """Whether a combination of a kind and a topic that is not on the list is nearer than the entry."""
        for k, t in self.pairs.get(what, ()) if distance else ():
            for x in forms:
                if any(other != k and f"{other} {t}" not in self.listed and near(x, f"{other} {t}", distance - 1) for other in self.kinds):
                    return True
                rest = x[len(k) + 1 :] if x.startswith(k + " ") else ""
                if rest and any(self.topic_names[i] != t and f"{k} {self.topic_names[i]}" not in self.listed for i in self.topics.near(rest, distance - 1)):
                    return True
        return False


def reference_list(entries: DataFrame, key: str, name: str, affix: str | None = None, most: int = MOST_ENTRIES) -> tuple[list[tuple[int, str]], list[str]]:
    """Reads the list to the driver, after a check of its size."""
    rows = entries.select(F.col(key).cast("int").alias("k"), F.col(name).cast("string").alias("n"), (F.col(affix).cast("string") if affix else F.lit(None).cast("string")).alias("a")).where("k is not null and n is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the reference list has more than {most} entries")
    return [(r.k, r.n) for r in rows], sorted({r.a for r in rows if r.a})


def map_to_list(rows: DataFrame, seq: str, value: Column, entries: DataFrame, *, key: str, name: str, affix: str | None = None, exact: bool = False) -> DataFrame:
    """Columns seq, value and key: the entry meant by each non-blank value, 0 if none; values that are entries only if exact.

    There is no shuffle: each task keeps what it has found for the distinct values it met, so a value that a third of all rows share costs nothing more.
    """
    given, affixes = reference_list(entries, key, name, affix)
    names = {n: k for k, n in sorted(given, reverse=True)}
    schema = T.StructType([rows.schema[seq], T.StructField("value", T.StringType()), T.StructField(key, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(given, affixes)
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            ids = []
            for x in coded.dictionary.to_pylist():
                blank = x is None or not x.strip()
                ids.append(None if blank or (x in names and not exact) else names[x] if x in names else matcher.of(x))
            found = pa.array(ids, pa.int32()).take(coded.indices)
            keep = found.is_valid()
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), found.filter(keep)], names=[seq, "value", key])

    return rows.select(F.col(seq), value.cast("string").alias("value")).mapInArrow(run, schema)
