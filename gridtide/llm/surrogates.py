"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detected are e-mail addresses, telephone numbers, social security numbers, IPv4 addresses, IBANs, long account
numbers and titled names of persons. An entity is a type and a canonical form, so that all spellings of it, in all documents, get the
same surrogate. The surrogate is drawn from a keyed hash and written in the format of the mention.

Persons are linked within a document (`_persons`): a title makes a person known, and shorter or untitled mentions
of them get the matching words of the same surrogate. The gender is that of the first title that has one.

Different entities must stay different. The distinct entities of the corpus draw surrogates; where two
entities draw the same, or one draws what occurs in the corpus, all but one draw again, until none collide. A
form of number (a private range of addresses, say, or short telephone numbers) of which the corpus holds a quarter
would leave too little to draw from: there the surrogates are a keyed permutation of the form, which is distinct by
itself; such a surrogate may be a number that occurs elsewhere in the corpus.
Only the entities with further draws travel to the texts: as a broadcast up to `BROADCAST_ROWS` of them, by
a join beyond.

Each kind of number has its own pattern over the whole text, and a telephone number ends where another number
begins (`_phones`). Cases: a null text is empty. Mentions do not overlap; of two that would, the kind that comes
first in `detect` counts. Rows with
equal id and text get equal results; null ids are ids like others. Columns of the input whose names the
result uses are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import hmac
import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from gridtide.session import cut

BROADCAST_ROWS = 200_000

# Titles by gender, and invented persons' names by gender and script.
TITLES = {
    "m": "Mr Herr Monsieur Señor Don Signor Mister Господин".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Señorita Doña Signora Госпожа".split(),
    "n": "Dr Prof Professor Docteur Доктор".split(),
}
GIVEN = {
    ("m", "latin"): "Adrian Benno Carl Dario Emil Felix Gustav Hugo Ivo Jonas Karim Leon Mario Nils Oscar Pablo Quentin Rafael Simon Tomas".split(),
    ("f", "latin"): "Alma Berta Clara Diana Elena Flora Greta Hanna Ines Julia Karin Lena Maria Nora Olga Paula Rosa Sofia Tessa Vera".split(),
    ("n", "latin"): "Alexis Ariel Charlie Dominique Eden Jules Kim Lou Maxime Noa Robin Sacha Sam Toni Yael".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Марк Олег".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Зоя Ирина Лидия Мария Нина Ольга".split(),
    ("n", "cyrillic"): "Женя Валя Саша Шура Слава".split(),
    ("n", "greek"): "Άρης Βάσω Ζωή Ηλίας Θάλεια Νίκη Σταύρος Φώτης".split(),
}
FAMILY = {
    "latin": "Abel Bauer Castell Dorn Ebert Falk Garnier Holm Ibarra Jansen Keller Lorenz Moreau Navarro Olsen Prado Quist Rivas Sauer Thorne Ullmann Vidal Weber Zeller".split(),
    "cyrillic": "Белов Волков Громов Дроздов Ершов Зуев Крылов Лебедев Морозов Орлов".split(),
    "greek": "Δήμου Καρράς Λάμπρου Μάνος Παππάς Ρήγας Σάββας Χατζής".split(),
}
_titles = "|".join(sorted({t for names in TITLES.values() for t in names}, key=len, reverse=True))

EMAIL = regex.compile(r"(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])")
IP = regex.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\w)")
IBAN = regex.compile(r"(?<![\w.])[A-Z]{2}\d{2}(?P<gap> ?)(?:[A-Z0-9]{4}(?P=gap)){2,7}[A-Z0-9]{1,4}(?!\w)")
SSN = regex.compile(r"(?<![\w.]|\d-)\d{3}-\d{2}-\d{4}(?![\w-])")
ACCOUNT = regex.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}(?P<between>[ -])\d{4}(?P=between)\d{4}(?P=between)\d{4})(?![\w-]|\.\d)")
PHONE = regex.compile(r"(?<![\w.])(?:\+(?P<country>\d{1,3})[ .-]?)?(?:\((?P<area>\d{2,4})\)[ .-]?)?(?P<group>\d{2,4})(?:[ .-](?P<group>\d{2,4})){1,3}(?!\w)")
# a number in the form of country code 1, whose last group could begin an account
SURE_PHONE = regex.compile(r"(?<![\w.]|\+\d{1,3}[ .-]?)(?:\+1[ .-]?(?:\(\d{3}\)[ .-]?|\d{3}[ .-]?)|\(\d{3}\)[ .-]?)\d{3}[ .-]\d{4}(?![\w]|[.-]\d)")
YEAR = re.compile(r"(?:19|20)\d\d")
# What every number above contains; most texts have neither, and are done at that.
LIKELY = re.compile(r"\d[\d .()+-]{5,}|[A-Z]{2}\d{2}")
_academic = "|".join(TITLES["n"])
_word = r"\p{Lu}[\p{L}'’-]+"
_particles = "(?:(?:van|von|der|den|de|la|las|los|del|della|di|da|du|le|ten|ter|zu|zur|zum|bin|ibn|al|el|dos|das|af|av|y|e) )"
_initials = r"(?:\p{Lu}\. ?)"
PERSON = regex.compile(
    rf"(?<!\w)(?P<title>{_titles})\.? (?:(?P<title>{_academic})\.? )*"
    rf"(?P<name>(?!(?:{_academic})\b)(?:{_initials}|{_particles})*{_word}(?: (?!(?:{_titles})\.? \p{{Lu}})(?:{_initials}|{_particles})*{_word})*)"
)
NAMES = regex.compile(rf"(?<!\w){_word}(?: {_word})*")
INITIAL = regex.compile(r"\p{Lu}\.")
PERMUTED = -1  # in place of the number of a draw
ENDING = regex.compile(r"(?:['’]s|['’-]+)$")  # not part of a name


@dataclass(frozen=True)
class Mention:
    begin: int
    end: int
    kind: str
    canon: str
    text: str
    words: tuple[int, ...] = ()  # of a person: the words of the whole name that stand here; none for all


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def script_of(text: str) -> str:
    for c in text:
        name = unicodedata.name(c, "")
        for script in ("CYRILLIC", "GREEK"):
            if name.startswith(script):
                return script.lower()
    return "latin"


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A word or number behind an IBAN is not part of it if the check digits say so."""
    at = 0
    while m := IBAN.search(text, at):
        ends = [m.end()] + [k for k in range(m.end() - 1, m.start() + 14, -1) if text[k] == " "]
        at = next((e for e in ends if _mod97(text[m.start() : e].replace(" ", "")) == 1), m.end())
        yield m.start(), at


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Of accounts that overlap in a row of groups, those that begin a row and have right check digits come first."""
    found, taken = [m.span() for m in ACCOUNT.finditer(text, overlapped=True)], []
    for begin, end in sorted(found, key=lambda s: (text[max(0, s[0] - 1)] in "-." and text[s[0] + 4] == " ", _luhn(_digits(text[s[0] : s[1]])) != 0, s[0])):
        k = bisect.bisect(taken, (begin, end))
        if (not k or taken[k - 1][1] <= begin) and (k == len(taken) or end <= taken[k][0]):
            taken.insert(k, (begin, end))
    yield from taken


def _phones(text: str) -> Iterator[tuple[int, int]]:
    """Telephone numbers, without the numbers beside them.

    A number of the form 3-3-4, with or without country code 1, ends there. Others end before a group set off by a
    space if closer separators stand in front, and before a year if the number is long enough without. Else, up to
    four groups and 15 digits belong to the number.
    """
    at = 0
    while m := PHONE.search(text, at):
        groups = m.spans("group")
        seps = [text[b - 1] for b, _ in groups[1:]]
        sizes = [e - b for b, e in groups]
        plain = not (m["country"] or m["area"])
        end = None
        if not (plain and sizes[1:] == [3, 3, 4] and seps[0] == " " and seps[1] == seps[2] != " "):  # else a number stands before a telephone number
            for k in range(1, len(groups)):
                n = len(_digits(text[m.start() : groups[k][1]]))
                if not (9 if plain else 7) <= n <= 15:
                    continue
                end = groups[k][1]
                if k + 1 == len(groups):
                    break
                known = n == 11 and text.startswith("+1", m.start()) or m["area"] and not m["country"] and n == 10 and sizes[k] == 4 or plain and sizes[: k + 1] == [3, 3, 4]
                year = seps[k] == " " and YEAR.fullmatch(text, *groups[k + 1])
                looser = seps[k] == " " and seps[k - 1] != " "
                if known or looser and (n >= 9 or year) or year and n >= 10:
                    break
        if end:
            yield m.start(), end
        # what is no telephone number hides none behind it
        at = end or (groups[0][1] if plain else m.start() + 1)


@dataclass
class Person:
    gender: str
    name: tuple[str, ...]
    begin: int  # of the first mention with a title
    spans: list[tuple[int, int, tuple[int, ...]]]  # mentions, and the words of the name that stand there


def _within(words: tuple[str, ...], name: tuple[str, ...]) -> tuple[int, ...] | None:
    """The places of the words in the name, in its order; None if one is not there."""
    places, at = [], 0
    for w in words:
        if w not in name[at:]:
            return None
        at = name.index(w, at) + 1
        places.append(at - 1)
    return tuple(places)


def _persons(text: str) -> list[Mention]:
    """The mentions of all persons whom a title introduces.

    A name belongs to a longer one whose words contain its words in order, unless the titles' genders differ. Untitled,
    two words or more do so in the whole text, one word only behind the title. Where several persons fit, the last
    one introduced before the mention counts.
    """
    titled = []
    for m in PERSON.finditer(text):
        gender = next((g for t in m.captures("title") for g in "mf" if t in TITLES[g]), "n")
        begin, name = m.start("name"), ENDING.sub("", m["name"])
        titled.append((begin, begin + len(name), gender, tuple(ENDING.sub("", w) for w in name.casefold().split(" "))))
    if not titled:
        return []
    persons: list[Person] = []
    with_word: dict[str, list[Person]] = {}

    def fitting(words: tuple[str, ...], begin: int, gender: str) -> Person | None:
        fit = [p for p in with_word.get(words[0], ()) if (gender == "n" or p.gender in ("n", gender)) and _within(words, p.name) is not None]
        before = [p for p in fit if p.begin <= begin]
        return max(before, key=lambda p: p.begin) if before else min(fit, key=lambda p: p.begin) if fit else None

    for begin, end, gender, words in sorted(titled, key=lambda t: (-len(t[3]), t[0])):
        person = fitting(words, begin, gender)
        if not person:
            person = Person(gender, words, begin, [])
            persons.append(person)
            for w in set(words):
                with_word.setdefault(w, []).append(person)
        person.gender = gender if person.gender == "n" else person.gender
        person.begin = min(person.begin, begin)
        person.spans.append((begin, end, _within(words, person.name)))
    taken = sorted((begin, end) for begin, end, _, _ in titled)
    longest = max(len(p.name) for p in persons)
    for m in NAMES.finditer(text):
        words = [(w.start(), w.start() + len(ENDING.sub("", w[0])), ENDING.sub("", w[0]).casefold()) for w in regex.finditer("[^ ]+", text, pos=m.start(), endpos=m.end())]
        k = 0
        while k < len(words):
            begin, size = words[k][0], 1
            if words[k][2] in with_word:
                at = bisect.bisect(taken, (begin, len(text)))
                free = not at or taken[at - 1][1] <= begin
                until = taken[at][0] if at < len(taken) else len(text)
                for n in range(min(longest, len(words) - k), 0, -1) if free else ():
                    some = words[k : k + n]
                    name = tuple(w for _, _, w in some)
                    person = fitting(name, begin, "n") if len(some) == n and some[-1][1] <= until else None
                    if person and (n > 1 or person.begin < begin):
                        person.spans.append((begin, some[-1][1], _within(name, person.name)))
                        size = n
                        break
            k += size
    out = []
    for p in persons:
        canon = f"{p.gender}:{script_of(p.name[0])}:{' '.join(p.name)}"
        out += [Mention(b, e, "person", canon, text[b:e], () if len(places) == len(p.name) else places) for b, e, places in p.spans]
    return out


def detect(text: str) -> list[Mention]:
    """The mentions in a text, in order, without overlaps."""
    found, left = [], text

    def take(kind: str, spans: list[tuple[int, int]]) -> None:
        """The next kinds do not see what was taken."""
        nonlocal left
        at, parts = 0, []
        for begin, end in sorted(spans):
            mention = text[begin:end]
            canon = mention.lower() if kind == "email" else mention.replace(" ", "") if kind in ("ip", "iban") else ("+" if mention[0] == "+" else "") + _digits(mention)
            found.append(Mention(begin, end, kind, canon, mention))
            parts += [left[at:begin], "\0" * (end - begin)]
            at = end
        left = "".join(parts) + left[at:] if parts else left

    if "@" in text:
        take("email", [m.span() for m in EMAIL.finditer(text)])
    if LIKELY.search(text):
        take("ip", [m.span() for m in IP.finditer(left)])
        take("iban", list(_ibans(left)))
        take("ssn", [m.span() for m in SSN.finditer(left)])
        take("phone", [m.span() for m in SURE_PHONE.finditer(left)])
        take("account", list(_accounts(left)))
        take("phone", list(_phones(left)))
    found += _persons(left)
    return sorted(found, key=lambda m: m.begin)


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, kind: str, canon: str, attempt: int):
        self.key, self.seed, self.count, self.pool = key, f"{kind}\0{canon}\0{attempt}\0".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.digest(self.key, self.seed + str(self.count).encode(), hashlib.sha256)
            self.count += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value * n >> 32

    def like(self, c: str) -> str:
        """A character of the same class."""
        if c.isdigit():
            return str(1 + self.below(9)) if c != "0" else str(self.below(10))
        if c.isalpha():
            return "abcdefghijklmnopqrstuvwxyz"[self.below(26)] if script_of(c) == "latin" else chr((0x430 if script_of(c) == "cyrillic" else 0x3B1) + self.below(16))
        return c


def _luhn(digits: str) -> int:
    twice = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _domain(key: bytes, domain: str) -> str:
    """The same for all addresses of a domain; the top level stays."""
    draw = Draw(key, "domain", domain, 0)
    *labels, top = domain.split(".")
    return ".".join(["".join(map(draw.like, label)) for label in labels] + [top])


def _parted(kind: str, canon: str) -> tuple[str, str]:
    """What a surrogate keeps of a number, and the rest."""
    if kind == "ip":
        parts = canon.split(".")
        kept = 1 if parts[0] in ("10", "127") else 2 if parts[:2] == ["192", "168"] else 0
        return "".join(p + "." for p in parts[:kept]), ".".join(parts[kept:])
    kept = 2 if canon.startswith("+") else 0
    return canon[:kept], canon[kept:]


def form_of(kind: str, canon: str) -> tuple[str, int] | None:
    """The form of a number and how many surrogates can be drawn in it at least; None for kinds without an end."""
    if kind not in ("ip", "phone", "ssn", "account"):
        return None
    kept, rest = _parted(kind, canon)
    if kind == "ip":
        return f"ip:{kept}", 222 * 254 ** rest.count(".") if not kept else 254 ** (rest.count(".") + 1)
    return f"{kind}:{kept}:{len(rest)}", 9 ** (len(rest) - (kind == "account"))


def _shuffled(key: bytes, name: str, value: int, size: int) -> int:
    """The place of `value` in a keyed permutation of the numbers below `size`."""
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    left, right = divmod(value, a)
    for turn in range(10):
        mixed = lambda x: int.from_bytes(hmac.digest(key, f"{name}\0{turn}\0{x}".encode(), hashlib.sha256), "big")  # noqa: B023, E731
        if turn % 2:
            right = (right + mixed(left)) % a
        else:
            left = (left + mixed(right)) % b
    out = left * a + right
    return out if out < size else _shuffled(key, name, out, size)  # walks on to the next that is small enough


def permuted(key: bytes, kind: str, canon: str) -> str:
    """The surrogate of a number in the permutation of its form; different numbers have different ones."""
    form, _ = form_of(kind, canon)
    kept, rest = _parted(kind, canon)
    while True:
        if kind == "ip":
            octets = rest.split(".")
            value = _shuffled(key, form, int.from_bytes(bytes(map(int, octets)), "big"), 256 ** len(octets))
            rest = ".".join(map(str, value.to_bytes(len(octets), "big")))
        elif kind == "account":
            beyond = (int(rest[-1]) + _luhn(rest[:-1] + "0")) % 10  # 0 for a right check digit
            body = str(_shuffled(key, form, int(rest[:-1]), 10 ** (len(rest) - 1))).zfill(len(rest) - 1)
            rest = body + str((beyond - _luhn(body + "0")) % 10)
        else:
            rest = str(_shuffled(key, form, int(rest), 10 ** len(rest))).zfill(len(rest))
        if form_of(kind, kept + rest) == form_of(kind, canon):
            return kept + rest


def surrogate(key: bytes, kind: str, canon: str, attempt: int = 0) -> str:
    """The canonical surrogate of an entity at its `attempt`-th draw, or in the permutation of its form."""
    if attempt == PERMUTED:
        return permuted(key, kind, canon)
    draw = Draw(key, kind, canon, attempt)
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        return "".join(map(draw.like, local + "a" * (attempt // 4))) + "@" + _domain(key, domain)
    if kind == "ip":
        kept, rest = _parted(kind, canon)
        drawn = [str(1 + draw.below(254 if kept or k else 223)) for k in range(rest.count(".") + 1)]
        return kept + ".".join(drawn)
    if kind == "iban":
        out = canon[:2] + "".join(map(draw.like, canon[2:])).upper()
        return f"{out[:2]}{98 - _mod97(out[:2] + '00' + out[4:]):02d}{out[4:]}" if _mod97(canon) == 1 else out
    if kind in ("phone", "account", "ssn"):
        kept = 2 if canon.startswith("+") else 0
        out = canon[:kept] + "".join(map(draw.like, canon[kept:]))
        if kind == "account" and _luhn(canon) == 0:
            out = out[:-1] + str((10 - _luhn(out[:-1] + "0")) % 10)
        return out
    gender, script, name = canon.split(":", 2)
    parts = name.split(" ")
    given = GIVEN.get((gender, script)) or GIVEN[("n", script)]
    words = [given[draw.below(len(given))]] if len(parts) > 1 else []
    # a further draw may need more names than there are: then names are joined
    count = max(1, len(parts) - 1)
    for k in range(count):
        family = [FAMILY[script][draw.below(len(FAMILY[script]))] for _ in range(1 + (attempt // 2 if k == count - 1 else 0))]
        words.append("-".join(family))
    return f"{gender}:{script}:{' '.join(words).casefold()}"


def render(mention: Mention, drawn: str) -> str:
    """A surrogate in the format of the mention: its separators and its case."""
    if mention.kind == "iban":
        chars = iter(drawn)
        return "".join(c if c == " " else next(chars) for c in mention.text)
    if mention.kind in ("phone", "account", "ssn"):
        digits = iter(_digits(drawn))
        return "".join(next(digits) if c.isdigit() else c for c in mention.text)
    if mention.kind == "person":
        words = drawn.split(":", 2)[2].split(" ")
        words = [words[k] for k in mention.words] or words
        if mention.text.isupper():
            return " ".join(words).upper()
        shown = ["-".join(part[:1].upper() + part[1:] for part in w.split("-")) for w in words]
        old = mention.text.split(" ")
        if len(old) == len(shown):  # particles stay, initials stay initials
            shown = [o if o.islower() else w[0] + "." if INITIAL.fullmatch(o) else w for o, w in zip(old, shown)]
        return " ".join(shown)
    if mention.kind == "email":
        if mention.text.isupper():
            return drawn.upper()
        if len(drawn) == len(mention.text):
            return "".join(d.upper() if c.isupper() else d for c, d in zip(mention.text, drawn))
    return drawn


def _entities(docs: DataFrame, text_col: str) -> DataFrame:
    """The distinct entities; each task returns an entity once in a while only."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            new = {(m.kind, m.canon) for text in batch.column(0).to_pylist() if text for m in detect(text)} - seen
            if len(seen) > 200_000:
                seen.clear()
            seen |= new
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in new], pa.string()), pa.array([c for _, c in new], pa.string())], ["kind", "canon"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(find, "kind string, canon string").distinct()


def _full_forms(entities: DataFrame) -> set[str]:
    """The forms of which the corpus holds a quarter or more. Short numbers only have such forms, some hundreds in all."""

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form for row in zip(*(c.to_pylist() for c in batch.columns)) if (form := form_of(*row)) and form[1] < 1 << 60]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["form", "size"])

    counted = entities.mapInArrow(forms, "form string, size long").groupBy("form", "size").agg(F.count("*").alias("n"))
    return {r.form for r in counted.where("n >= size / 4").select("form").collect()}


def further_draws(docs: DataFrame, key: bytes, text_col: str = "text") -> tuple[DataFrame, set[str]]:
    """`kind`, `canon`, `attempt` of the entities that may not use their first draw, and the forms that are permuted.

    Of other forms less than a quarter occurs and less than a quarter is taken, so a draw finds a free one half
    of the time at least.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [surrogate(key, *row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], ["kind", "canon", "attempt", "drawn"])

    entities = cut(_entities(docs, text_col), "entities")
    full = _full_forms(entities)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(form_of(*row) or ("",))[0] not in full for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    entities = entities.mapInArrow(others, "kind string, canon string") if full else entities
    real = entities.select("kind", F.col("canon").alias("drawn"))
    waiting, settled = entities.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = cut(waiting.mapInArrow(draw, "kind string, canon string, attempt int, drawn string"), "drawn")
        free = drawn.join(real, ["kind", "drawn"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "drawn"), ["kind", "drawn"], "left_anti")
        first = free.groupBy("kind", "drawn").agg(F.min("canon").alias("canon"), F.first("attempt").alias("attempt"))
        won = cut(first.select("kind", "canon", "attempt", "drawn"), "won")
        settled = won if settled is None else settled.unionByName(won)
        lost = drawn.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti")
        waiting = cut(lost.select("kind", "canon", (F.col("attempt") + 1).alias("attempt")), "waiting")
        if waiting.isEmpty():
            return settled.where(F.col("attempt") > 0).select("kind", "canon", "attempt"), full


def replace_personal(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with surrogates in the text, and `entities`: (kind, begin, end) in the text as it was."""
    spark = docs.sparkSession
    further, full = further_draws(docs, key, text_col)
    redrawn = cut(further, "redrawn")
    others = [c for c in docs.columns if c not in (text_col, "entities", "redrawn_", "doc_tag")]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*others, text.alias(text_col))
    known = None
    if redrawn.count() <= BROADCAST_ROWS:
        known = spark.sparkContext.broadcast({(r.kind, r.canon): r.attempt for r in redrawn.collect()})
        rows = rows.withColumn("redrawn_", F.lit(None).cast("array<struct<kind:string,canon:string,attempt:int>>"))
    else:
        rows = rows.withColumn("doc_tag", F.xxhash64(F.col(id_col).cast("string"), text_col))
        per_doc = _mentioned(rows.select("doc_tag", text_col)).join(redrawn, ["kind", "canon"])
        per_doc = per_doc.groupBy("doc_tag").agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("redrawn_"))
        rows = rows.join(per_doc, "doc_tag", "left").select(*others, text_col, "redrawn_")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = functools.lru_cache(maxsize=100_000)(functools.partial(surrogate, key))
        for batch in batches:
            texts, spans = [], []
            for text, own in zip(batch.column(len(others)).to_pylist(), batch.column(len(others) + 1).to_pylist()):
                attempts = known.value if known else {(r["kind"], r["canon"]): r["attempt"] for r in own or []}
                found, parts, at = detect(text), [], 0
                for m in found:
                    own_form = form_of(m.kind, m.canon) if full else None
                    attempt = PERMUTED if own_form and own_form[0] in full else attempts.get((m.kind, m.canon), 0)
                    parts += [text[at : m.begin], render(m, drawn(m.kind, m.canon, attempt))]
                    at = m.end
                texts.append("".join(parts) + text[at:])
                spans.append([{"kind": m.kind, "begin": m.begin, "end": m.end} for m in found])
            listed = pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string()), listed], [*others, text_col, "entities"])

    span = StructType().add("kind", "string").add("begin", "integer").add("end", "integer")
    schema = rows.select(*others, text_col).schema.add("entities", ArrayType(span))
    return rows.mapInArrow(write, schema)


def _mentioned(rows: DataFrame) -> DataFrame:
    """`doc_tag`, `kind`, `canon`, once for each document and entity."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(tag, *e) for tag, text in zip(*(c.to_pylist() for c in batch.columns)) for e in {(m.kind, m.canon) for m in detect(text)}]
            tags, kinds, canons = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(tags, pa.int64()), pa.array(kinds, pa.string()), pa.array(canons, pa.string())], ["doc_tag", "kind", "canon"])

    return rows.mapInArrow(find, "doc_tag long, kind string, canon string")
