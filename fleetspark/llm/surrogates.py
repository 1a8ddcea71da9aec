"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detected: e-mail addresses, phone numbers, IPv4 addresses, payment card numbers
(Luhn holds), IBANs (mod 97 holds), US social security numbers, and persons
named after a title, by a known given name and a surname, or after a cue such as
"my name is". Every other bare mention, in the same text, of a name so found is
replaced by the same surrogate.

A surrogate is a keyed permutation within the entity's own format: the symbols
that may change (digits, letters; vowels and consonants apart for names) form a
number in a mixed radix, a Feistel network under the key permutes the numbers
of that format, and the rest (punctuation, country codes, top-level domains,
titles, case) stays. Check digits are computed anew. Given names are permuted
in one keyed cycle within the list of their gender and script, so each one changes. As each format is permuted,
different entities get different surrogates, and every mention of an entity,
in any punctuation and in any document, gets the same one.

Collision checks in Spark: over all distinct entities a surrogate may equal
neither another's surrogate nor any value that occurs in the corpus; those that
do are drawn again under the next round's key until none is left. Only these
exceptions are looked up (by a join of the texts that hold one); all other
surrogates are computed where they are needed.

Defined results: a null text stays null; texts without entities stay
byte-identical; a format without a free symbol has only itself and stays;
an empty table gives no rows; repeated rows get equal texts. A short
format that is used up (no free surrogate after ``ROUNDS`` draws) is widened by
a few symbols, as distinctness comes before format.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from itertools import count
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import CHUNK_BYTES, chunks, map_arrow, shared_table
from fleetspark.llm.substrings import Filter

ROUNDS = 8
MEMO = 200_000

# Titles by gender, and given names by script and gender (spellings as they occur in texts).
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f",
          "Mademoiselle": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Dr": "", "Prof": "", "господин": "m", "госпожа": "f"}
GIVEN = {
    ("latin", "m"): """
        James Robert Michael William Richard Thomas Charles Daniel Matthew Anthony Stefan Klaus Jürgen Wolfgang Pierre François Antoine
        Carlos Javier Miguel David John Joseph Christopher Steven Paul Andrew Joshua Kenneth Kevin Brian George Timothy Ronald Edward
        Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick
        Raymond Dennis Jerry Tyler Aaron Adam Nathan Henry Douglas Zachary Peter Kyle Noah Ethan Jeremy Walter Christian Keith Roger Terry
        Austin Sean Gerald Carl Dylan Harold Jordan Jesse Bryan Lawrence Arthur Gabriel Bruce Logan Albert Willie Alan Juan Wayne Elijah
        Randy Roy Vincent Ralph Eugene Russell Bobby Philip Louis Liam Oliver Lucas Oscar Leo Simon Martin Mohammed Muhammad Ahmed Ali
        Omar Hassan Ibrahim Yusuf Hans Günter Heinz Horst Dieter Uwe Bernd Jörg Matthias Andreas Markus Tobias Sebastian Florian Lukas
        Jonas Felix Maximilian Friedrich Heinrich Johann Karl Ludwig Otto Rainer Manfred Helmut Jean Jacques Michel Philippe Alain Nicolas
        Julien Laurent Olivier Pascal Thierry Christophe Guillaume Mathieu Étienne René Luc Marcel Henri Gérard José Antonio Manuel
        Francisco Luis Pedro Jesús Alejandro Fernando Sergio Pablo Jorge Alberto Rafael Diego Andrés Ángel Raúl Enrique Ramón Vicente
        Álvaro Ignacio Eduardo Roberto Ricardo Giovanni Marco Luca Giuseppe Francesco Paolo Mario Andrzej Piotr Krzysztof Tomasz Jan Pavel
        Jiří Petr Ivan Sergei Dmitri Vladimir Alexei Mikhail Nikolai Boris Igor Oleg Yuri Lars Erik Anders Sven Björn Mehmet Mustafa
        Rajesh Rahul Amit Sanjay Vijay Arjun Hiroshi Kenji Takashi Wei""".split(),
    ("latin", "f"): """
        Mary Patricia Jennifer Elizabeth Barbara Susan Jessica Margaret Katharina Ursula Monika Sabine Camille Sophie Isabelle Carmen
        Lucía Beatriz Gabriela Natalia Anna Emma Linda Sarah Karen Lisa Nancy Betty Sandra Ashley Kimberly Emily Donna Michelle Carol
        Amanda Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Dorothy Amy Kathleen Angela Shirley Brenda Pamela Nicole Katherine
        Samantha Christine Helen Debra Rachel Carolyn Janet Maria Catherine Heather Diane Olivia Julie Joyce Victoria Kelly Christina
        Lauren Joan Evelyn Judith Megan Cheryl Andrea Hannah Jacqueline Martha Gloria Teresa Ann Sara Madison Frances Kathryn Janice
        Abigail Alice Julia Judy Sophia Denise Amber Doris Marilyn Danielle Beverly Isabella Theresa Diana Brittany Charlotte Marie Kayla
        Alexis Lori Ava Mia Amelia Ella Zoe Chloe Lucy Eva Nora Clara Jane Anne Fatima Aisha Maryam Zainab Layla Petra Renate Ingrid Helga
        Gisela Brigitte Karin Heike Birgit Anja Silke Claudia Susanne Angelika Katrin Johanna Lena Greta Frieda Hildegard Françoise
        Monique Nathalie Sylvie Valérie Céline Aurélie Élodie Chantal Dominique Hélène Geneviève Margaux Manon Inès Léa Chloé Zoé Amélie
        María Josefa Isabel Dolores Pilar Ana Cristina Marta Francisca Antonia Mercedes Rosario Elena Raquel Rocío Paula Alba Inés Sofía
        Valentina Camila Daniela Giulia Francesca Chiara Alessandra Katarzyna Agnieszka Małgorzata Ewa Jana Olga Tatiana Svetlana Irina
        Ekaterina Natasha Ludmila Galina Nadia Astrid Freja Elif Ayşe Priya Anjali Deepa Sunita Yuki Sakura Mei""".split(),
    ("cyrillic", "m"): """
        Александр Сергей Дмитрий Андрей Алексей Иван Михаил Николай Владимир Пётр Петр Павел Евгений Максим Артём Артем Олег Игорь Юрий
        Виктор Василий Борис Григорий Константин Роман Денис Антон Илья Кирилл Никита Егор Фёдор Федор Станислав Вячеслав Леонид Тарас
        Богдан""".split(),
    ("cyrillic", "f"): """
        Анна Мария Елена Ольга Наталья Екатерина Татьяна Ирина Светлана Юлия Анастасия Людмила Галина Валентина Нина Дарья Ксения Полина
        Виктория Александра Евгения Надежда Тамара Лариса Софья София Алина Вера Оксана Марина""".split(),
}
_GENDER = {name: key for key, names in GIVEN.items() for name in names}

_NAME = r"[^\W\d_]*[a-zà-öø-ÿа-яё]"
_UPPER = r"[A-ZÀ-ÖØ-ÞА-ЯЁ]"
_WORD = re.compile(rf"(?<!\w){_UPPER}{_NAME}(?!\w)")
#: Words that a person's name follows.
CUES = ("my name is ", "My name is ", "ich heiße ", "Ich heiße ", "mein Name ist ", "Mein Name ist ", "je m'appelle ", "Je m'appelle ",
        "me llamo ", "Me llamo ", "mi nombre es ", "Mi nombre es ", "меня зовут ", "Меня зовут ")
PATTERNS: dict[str, re.Pattern] = {
    "email": re.compile(r"@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"),  # the local part is read from the @ to the left
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "card": re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "ipv4": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    "phone": re.compile(r"(?<!\w)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"),
    "person": re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.? +{_UPPER}{_NAME}(?: +{_UPPER}{_NAME})?|(?={_UPPER})(?:{'|'.join(_GENDER)}) +{_UPPER}{_NAME}"
                         rf"|(?={_UPPER})(?:{'|'.join(f'(?<={cue})' for cue in CUES)}){_UPPER}{_NAME}(?: +{_UPPER}{_NAME})?)(?!\w)"),
}
KINDS = tuple(PATTERNS)

#: Symbols of the local part of an address.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_LOWER, _CAPITAL, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_VOWELS = {"latin": "aeiou", "cyrillic": "аеиоуыэюя"}
_CONSONANTS = {"latin": "bcdfghjklmnpqrstvwxyz", "cyrillic": "бвгджзклмнпрстфхцчшщ"}
_PLAIN = str.maketrans("áàâäãåéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc")
#: Symbols that a symbol of a name may become.
_NAME_SETS = {c: s[case] for s in ((group, group.upper()) for table in (_VOWELS, _CONSONANTS) for group in table.values())
              for case in (0, 1) for c in s[case]}
_CODE_SETS = {c: group for group in (_LOWER, _CAPITAL, _DIGIT) for c in group}
_DIGIT_SETS = dict.fromkeys(_DIGIT, _DIGIT)


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def permute(n: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of 0..size-1: a Feistel network on two digits, walked until it falls inside."""
    if size < 2:
        return n
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(n, b)
        for r in range(8):
            other = right if r % 2 == 0 else left
            h = int.from_bytes(hashlib.blake2b(f"{tweak}|{size}|{r}|{other}".encode(), key=key, digest_size=32).digest(), "big")
            if r % 2 == 0:
                left = (left + h) % a
            else:
                right = (right + h) % b
        n = left * b + right
        if n < size:
            return n


def scramble(text: str, sets: dict[str, str], key: bytes, tweak: str) -> str:
    """Permute the symbols of a text that have a set, each within its set; the others stay and are part of the format."""
    shape = "".join("_" if c in sets else c for c in text)
    n, size = 0, 1
    for c in text:
        if c in sets:
            n = n * len(sets[c]) + sets[c].index(c)
            size *= len(sets[c])
    radix = "".join(sets[c][0] if c in sets else "" for c in text)
    n = permute(n, size, key, f"{tweak}|{shape}|{radix}")
    out = []
    for c in reversed(text):
        if c in sets:
            n, k = divmod(n, len(sets[c]))
            out.append(sets[c][k])
        else:
            out.append(c)
    return "".join(reversed(out))


def _script(word: str) -> str:
    return "cyrillic" if re.search("[а-яёА-ЯЁ]", word) else "latin"


def _person_parts(mention: str) -> list[tuple[str, str]]:
    """(part kind, text) pieces of a mention, white space and titles included, in order."""
    pieces = re.split(r"( +)", mention)
    out, gender = [], ""
    for i, piece in enumerate(pieces):
        if not piece.strip():
            out.append(("", piece))
        elif i == 0 and piece.rstrip(".") in TITLES:
            gender = TITLES[piece.rstrip(".")]
            out.append(("", piece))
        elif piece in _GENDER:
            out.append(("given", piece))
        elif i < len(pieces) - 1 and gender:  # an unknown given name after a title
            out.append((f"given-{gender}", piece))
        else:
            out.append(("surname", piece))
    return out


def entity_values(kind: str, mention: str) -> list[tuple[str, str]]:
    """The entities that a mention stands for, as (kind, normal form); empty if its checks fail."""
    if kind == "email":
        return [("email", mention.lower())]
    if kind == "person":
        return [(part, text) for part, text in _person_parts(mention) if part]
    if kind not in PATTERNS:  # a bare part of a name
        return [(kind, mention)]
    if kind == "iban":
        value = mention.replace(" ", "")
        return [("iban", value)] if 15 <= len(value) <= 34 and _mod97(value) == 1 else []
    digits = "".join(c for c in mention if c in _DIGIT)
    if kind == "card":
        return [("card", digits)] if luhn(digits) else []
    if kind == "ipv4":
        return [("ipv4", mention)] if all(int(x) < 256 and x == str(int(x)) for x in mention.split(".")) else []
    return [(kind, ("+" if mention[0] == "+" else "") + digits)]


def _country(value: str) -> int:
    """Digits of a phone number's country code that stay (1 and 7 stand alone, else two)."""
    return 0 if value[0] != "+" else 2 if value[1] in "17" else 3


@lru_cache(maxsize=64)
def _given_order(group: tuple[str, str], key: bytes, tweak: str) -> list[str]:
    """The names of a list in a keyed order; each name's surrogate is the next one, so none stays."""
    return sorted(GIVEN[group], key=lambda name: hashlib.blake2b(f"{tweak}|{name}".encode(), key=key).digest())


def surrogate(kind: str, value: str, key: bytes, draw: int = 0) -> str:
    """Surrogate of an entity's normal form, in normal form."""
    tweak = f"{kind}|{draw}"
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        return scramble(local, _CODE_SETS, key, tweak) + "@" + ".".join([scramble(".".join(labels[:-1]), _CODE_SETS, key, tweak + "|domain"), labels[-1]])
    if kind == "card":
        body = value[0] + scramble(value[1:-1], _DIGIT_SETS, key, f"{tweak}|{value[0]}")
        return next(body + d for d in _DIGIT if luhn(body + d))
    if kind == "iban":
        body = scramble(value[4:], _CODE_SETS, key, f"{tweak}|{value[:2]}")
        return f"{value[:2]}{98 - _mod97(value[:2] + '00' + body):02d}{body}"
    if kind == "ipv4":
        a, b, c, d = map(int, value.split("."))
        n = permute(((a * 256 + b) * 256 + c) * 256 + d, 1 << 32, key, tweak)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "phone":
        k = _country(value)
        return value[:k] + scramble(value[k:], _DIGIT_SETS, key, f"{tweak}|{value[:k]}")
    if kind == "ssn":
        return scramble(value, _DIGIT_SETS, key, tweak)
    if kind == "given":
        order = _given_order(_GENDER[value], key, tweak)
        return order[(order.index(value) + 1) % len(order)]
    return scramble(value.translate(_PLAIN) if _script(value) == "latin" else value, _NAME_SETS, key, f"{tweak}|{_script(value)}")


def drawn(kind: str, value: str, key: bytes, draw: int) -> str:
    """The surrogate of a draw; from draw ``ROUNDS`` on, the format is taken for used up and grows with each draw."""
    longer = draw - ROUNDS + 1
    if longer < 1 or kind in ("card", "iban", "ipv4", "given"):  # far larger than any corpus, or permuted whole
        return surrogate(kind, value, key, draw)
    if kind == "email":
        return surrogate(kind, value.replace("@", ".aaaaaa" * longer + "@"), key)
    return surrogate(kind, value + ("0000" if kind in ("phone", "ssn") else "aaaa") * longer, key)


def dress(kind: str, mention: str, replace: Callable[[str, str], str]) -> str:
    """The mention in its own punctuation and case, with each entity replaced."""
    if kind == "person":
        return "".join(replace(part, text) if part else text for part, text in _person_parts(mention))
    (_, value), = entity_values(kind, mention)
    new = replace(kind, value)
    if kind == "email":
        return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new)) if len(new) == len(mention) else new
    if kind == "ipv4" or kind not in PATTERNS:
        return new
    symbols = iter(new.lstrip("+"))
    keep = "+" if kind == "phone" else ""
    return "".join(c if c in " -.()" or c in keep else next(symbols) for c in mention) + "".join(symbols)


def _emails(text: str):
    """Spans of addresses; each symbol is looked at once for an @ to its right and once for one to its left."""
    over, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > over and text[start - 1] in _LOCAL:
            start -= 1
        m = PATTERNS["email"].match(text, at) if start < at else None
        if m:
            yield start, m.end()
        over = m.end() if m else at + 1
        at = text.find("@", over)


def mentions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the mentions, leftmost first, without overlaps (kinds in their order win).

    A bare part of a person's name has the part's kind."""
    digits = any(map(text.__contains__, _DIGIT))
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        if kind == "email" and "@" not in text or kind not in ("email", "person") and not digits:
            continue
        for start, end in _emails(text) if kind == "email" else map(re.Match.span, pattern.finditer(text)):
            if entity_values(kind, text[start:end]):
                found.append((start, rank, end, kind))
    out, over = [], 0
    for start, _, end, kind in sorted(found):
        if start >= over:
            out.append((start, end, kind))
            over = end
    return _with_bare_names(text, out)


def _with_bare_names(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans and, between them, every bare mention of a name that a person among them has."""
    names = {}
    for start, end, kind in spans:
        if kind == "person":
            for part, word in _person_parts(text[start:end]):
                if part:
                    names.setdefault(word, part)
    if not names:
        return spans
    starts, more = [start for start, _, _ in spans], []
    for m in _WORD.finditer(text):
        if m[0] in names:
            i = bisect_right(starts, m.start())
            if (i == 0 or spans[i - 1][1] <= m.start()) and (i == len(spans) or m.end() <= starts[i]):
                more.append((m.start(), m.end(), names[m[0]]))
    return sorted(spans + more)


def rewrite(text: str, spans: list[tuple[int, int, str]], replace: Callable[[str, str], str]) -> str:
    parts, at = [], 0
    for start, end, kind in spans:
        parts += [text[at:start], dress(kind, text[start:end], replace)]
        at = end
    return "".join(parts) + text[at:]


class Keyed:
    """Memo of surrogates under one key."""

    def __init__(self, key: bytes):
        self.key, self.known = key, {}

    def __call__(self, kind: str, value: str) -> str:
        found = self.known.get((kind, value))
        if found is None:
            if len(self.known) > MEMO:
                self.known.clear()
            found = self.known[kind, value] = surrogate(kind, value, self.key)
        return found


def distinct_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """kind, value of every entity of the corpus, once."""

    def run(batches):
        for part in chunks(batches, "raw"):
            seen = {e for raw in part.column("raw").to_pylist() for text in (raw.decode("utf-8", "replace"),)
                    for s, t, kind in mentions(text) for e in entity_values(kind, text[s:t])}
            kinds, values = zip(*seen) if seen else ((), ())
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string())})

    src = docs.select(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("raw"))
    return map_arrow(src, run, "kind string, value string").distinct()


def exceptions(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value, surrogate of the entities whose first surrogate collides, with the draw that does not."""
    spark = entities.sparkSession

    def drawing(draw: int):
        def run(batches):
            for b in batches:
                kinds, values = b.column("kind").to_pylist(), b.column("value").to_pylist()
                yield pa.RecordBatch.from_pydict({"kind": b.column("kind"), "value": b.column("value"), "surrogate": pa.array(
                    [drawn(k, v, key, draw) for k, v in zip(kinds, values)], pa.string())})
        return run

    schema = "kind string, value string, surrogate string"
    family = F.when(F.col("kind").startswith("given-"), "surname").otherwise(F.col("kind"))
    taken = entities.select(family.alias("family"), F.col("value").alias("surrogate")).distinct()
    settled, open_ = None, entities
    for draw in count():  # each draw is checked, and the formats grow in the end
        now = shared_table(spark, map_arrow(open_, drawing(draw), schema).withColumn("family", family), "draws")
        first = now.groupBy("family", "surrogate").agg(F.min(F.struct("kind", "value")).alias("top"))
        # given names are permuted within their list, so each is somebody's surrogate; only doubles count there
        seen = taken if settled is None else taken.union(settled.select("family", "surrogate"))
        free = (first.join(seen.where("family <> 'given'"), ["family", "surrogate"], "left_anti")
                     .select(F.col("top.kind").alias("kind"), F.col("top.value").alias("value"), F.lit(True).alias("free")))
        judged = shared_table(spark, now.join(free, ["kind", "value"], "left"), "judged")
        good = judged.where("free").drop("free").withColumn("draw", F.lit(draw))
        settled = good if settled is None else settled.union(good)
        open_ = judged.where("free IS NULL").select("kind", "value")
        if open_.isEmpty():
            break
    return settled.where("draw > 0").select("kind", "value", "surrogate")


def _entity_key(kind: str, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}|{value}".encode(), digest_size=8).digest(), "little")


def _exception_filter(odd: DataFrame) -> Filter:
    def run(batches):
        for b in batches:
            keys = [_entity_key(k, v) for k, v in zip(b.column("kind").to_pylist(), b.column("value").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": pa.array(np.array(keys, np.uint64).view(np.int64))})

    return Filter.of(shared_table(odd.sparkSession, map_arrow(odd, run, "key long"), "keys"))


_ENTITY = pa.struct([("kind", pa.string()), ("value", pa.string())])


def replace_personal_data(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = "entities_by_kind") -> DataFrame:
    """The input rows with personal data replaced in ``text_col``; ``count_col`` (if named) holds mentions by kind."""
    spark = docs.sparkSession
    odd = shared_table(spark, exceptions(shared_table(spark, distinct_entities(docs, text_col), "entities"), key), "exceptions")
    any_odd = not odd.isEmpty()
    # exceptions are told by a filter of bounded size; a false hit only sends a text the longer way
    shared = spark.sparkContext.broadcast(_exception_filter(odd) if any_odd else None)
    columns = [F.col(c) for c in docs.columns if c != text_col]
    src = docs.select(F.struct(F.lit(0).alias("pad_"), *columns).alias("kept"), F.col(text_col).cast("binary").alias("raw"),
                      F.coalesce(F.octet_length(text_col), F.lit(0)).alias("size_"))
    kept_type = src.schema["kept"].dataType.simpleString()

    def first(batches):
        keyed = Keyed(key)
        for part in _text_chunks(batches):
            texts, counts, needs = [], [], []
            for raw in part.column("raw").to_pylist():
                text = None if raw is None else raw.decode("utf-8", "replace")
                spans = mentions(text) if text else []
                own = [e for s, t, kind in spans for e in entity_values(kind, text[s:t])]
                hard = any_odd and own and shared.value.has(np.array([_entity_key(*e) for e in own], np.uint64)).any()
                needs.append([{"kind": k, "value": v} for k, v in dict.fromkeys(own)] if hard else None)
                texts.append(text if hard or not spans else rewrite(text, spans, keyed))
                counts.append(list(Counter(kind if kind in PATTERNS else "person" for _, _, kind in spans).items()))
            yield pa.RecordBatch.from_pydict({"kept": part.column("kept"), "text_": pa.array(texts, pa.string()),
                                              "counts": pa.array(counts, pa.map_(pa.string(), pa.int64())), "needs": pa.array(needs, pa.list_(_ENTITY))})

    def second(batches):
        keyed = Keyed(key)
        for part in batches:
            texts = []
            for text, known in zip(part.column("text_").to_pylist(), part.column("known").to_pylist()):
                own = {(x["kind"], x["value"]): x["surrogate"] for x in known or ()}
                texts.append(rewrite(text, mentions(text), lambda k, v, own=own: own.get((k, v)) or keyed(k, v)))
            yield pa.RecordBatch.from_pydict({"kept": part.column("kept"), "text_": pa.array(texts, pa.string()), "counts": part.column("counts")})

    schema = f"kept {kept_type}, text_ string, counts map<string,bigint>"
    out = map_arrow(src, first, schema + ", needs array<struct<kind:string,value:string>>")
    if any_odd:
        hard = shared_table(spark, out.where("needs IS NOT NULL").withColumn("place", F.monotonically_increasing_id()), "hard")
        known = (hard.select("place", F.explode("needs").alias("e")).select("place", "e.kind", "e.value").join(odd, ["kind", "value"])
                     .groupBy("place").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("known")))
        again = map_arrow(hard.join(known, "place", "left").select("kept", "text_", "counts", "known"), second, schema)
        out = out.where("needs IS NULL").drop("needs").union(again)
    found = [F.col("text_").alias(c) if c == text_col else F.col(f"kept.`{c}`").alias(c) for c in docs.columns]
    return out.select(*found, *([F.col("counts").alias(count_col)] if count_col else []))


def _text_chunks(batches):
    """Batches cut by the bytes of their texts (null texts count nothing)."""
    for batch in batches:
        start = held = 0
        for i, n in enumerate(batch.column("size_").to_pylist()):
            if held and held + n > CHUNK_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
