"""Personal data and secrets in texts, as column expressions."""

from __future__ import annotations

import bisect
import contextlib
import datetime
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of what is looked for. Java's regular expressions, with look-around.
EMAIL = r"(?i)(?<![\w.+-])([A-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?(?:\.[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?)+)"
IPV4 = r"(?<![\w.])((?:\d{1,3}\.){3}\d{1,3})(?![\w.])"
GUARDED_IPV4 = r"[^\w.]((?:\d{1,3}\.){3}\d{1,3})[^\w.]"
CARD = r"(?<!\d)((?:\d[ -]?){12,18}\d)(?!\d)"
PHONE = r"(?<![\w])((?:\+|00)?\d(?:[ .()/-]?\d){7,14})(?![\w])"
IBAN = r"(?i)(?<![A-Z0-9])([A-Z]{2}\d{2}[A-Z0-9]{11,30})(?![A-Z0-9])"
PASSPORT = r"(?i)(?:passport|paspoort|passeport|reisepass)(?:nummer|number|no|nr)?\s*[:#=-]?\s*([A-Z0-9]{6,12})"
SECRET = r"(?i)(?:token|secret|api[_-]?key|password)\s*[:=]\s*[\"']?([0-9a-f]{32,64}|[A-Za-z0-9_\-]{24,})[\"']?"
SENSITIVE = {
    "health": r"(?i)\b(?:diagnos(?:e|is)|diabetes|kanker|cancer|hiv|medic(?:atie|ation)|patient|pati[eë]nt|ziekte|disease|treatment|behandeling)\b",
    "financial": r"(?i)\b(?:salary|salaris|loon|income|inkomen|debt|schuld|balance|saldo|tax|belasting|bankrekening)\b",
    "political": r"(?i)\b(?:politieke overtuiging|political affiliation|party member|partijlid|stemgedrag|voting preference)\b",
    "religious": r"(?i)\b(?:religie|religion|geloof|faith|moslim|muslim|christen|christian|joods|jewish)\b",
    "criminal": r"(?i)\b(?:strafblad|criminal record|veroordeeld|convicted|verdachte|suspect|arrested|gearresteerd)\b",
    "minor": r"(?i)\b(?:minderjarige|minor|child|kind|leerling|pupil)\b.{0,40}\b(?:jaar|years? old|age|leeftijd)\b",
}


def found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), 1)


def emails(text: Column) -> Column:
    return found(text, EMAIL)


def ipv4(text: Column, guarded: bool = False) -> Column:
    """Dotted quads of numbers from 0 to 255 without leading zeros. With ``guarded`` each quad takes up the character on either side, as in SQL,
    whose patterns have no look-around: of two that are one character apart the second is passed over."""
    quads = found(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), GUARDED_IPV4) if guarded else found(text, IPV4)
    return F.filter(quads, lambda x: F.forall(F.split(x, r"\."), lambda p: (p.cast("int") <= 255) & (p == p.cast("int").cast("string"))))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def cards(text: Column) -> Column:
    """13 to 19 digits whose Luhn sum holds."""
    return F.filter(F.transform(found(text, CARD), digits), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def phones(text: Column) -> Column:
    """8 to 15 digits, not all alike, and not a date."""
    ok = lambda x: F.length(digits(x)).between(8, 15) & (F.length(F.replace(digits(x), F.substring(digits(x), 1, 1), F.lit(""))) > 0) & ~x.rlike(r"^\d{1,4}[./-]\d{1,2}[./-]\d{1,4}$")
    return F.filter(found(text, PHONE), ok)


def mod97(iban: Column) -> Column:
    """The remainder of the rearranged number with letters as 10 to 35."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda r, c: F.when(c.between("0", "9"), r * 10 + value(c)).otherwise(r * 100 + value(c)) % 97)


def ibans(text: Column) -> Column:
    return F.filter(F.transform(found(text, IBAN), lambda x: F.upper(x)), lambda x: F.length(x).between(15, 34) & (mod97(x) == 1))


def passports(text: Column) -> Column:
    return found(text, PASSPORT)


def secrets(text: Column) -> Column:
    return found(text, SECRET)


def sensitive(text: Column) -> Column:
    """Sorted names of the categories that the text mentions."""
    hits = F.array(*[F.when(F.coalesce(text, F.lit("")).rlike(p), F.lit(name)) for name, p in sorted(SENSITIVE.items())])
    return F.filter(hits, lambda x: x.isNotNull())


def outcome(n_secret: Column, n_restricted: Column, categories: Column, n_identifying: Column, n_redactable: Column) -> Column:
    """What happens to the text: the gravest that holds."""
    return (
        F.when(n_secret > 0, "escalate")
        .when(n_restricted > 0, "reject")
        .when(F.size(categories) > 0, "review")
        .when(n_identifying >= 3, "review")
        .when(n_redactable > 0, "remediate")
        .otherwise("accept")
    )

# The findings of one text, with spans. Python's regular expressions; no pattern differs between the two.
NATIONAL = r"(?<!\d)\d{2}[. /-]?\d{2}[. /-]?\d{2}[. /-]?\d{3}[. /-]?\d{2}(?!\d)"
IBAN_BE = r"(?i)(?<![A-Z0-9])BE\d{2}(?:[ -]?\d){12}(?![A-Z0-9])"
BORN = r"(?i)(?:geboren(?: op)?|geboortedatum|date de naissance|born(?: on)?|birth date|geburtsdatum)\s*[:=-]?\s*(\d{1,2}[./-]\d{1,2}[./-]\d{2,4})"
IP = r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.])"
COORDINATES = r"(?<![\d.])-?\d{1,2}(?:\.\d{4,})\s*[,;]\s*-?\d{1,3}(?:\.\d{4,})(?![\d.])"
WORD = r"[A-ZÀ-ÖØ-Ý][\wÀ-ÖØ-öø-ÿ'’-]+"
PHRASES = {
    "person_name": (rf"(?i)(?:naam|name|nom|patient|pati[eë]nt|client)\s*[:=-]\s*{WORD}(?:\s+{WORD}){{1,3}}", rf"(?i)(?:mr|mrs|ms|dr|meneer|mevrouw|monsieur|madame)\.?\s+{WORD}"),
    "postal_address": (
        rf"(?i)\b{WORD}(?:straat|laan|weg|steenweg|plein|kaai|dreef|markt|rue|avenue|boulevard|chauss[eé]e|straat)\s+\d{{1,5}}[A-Za-z]?(?:\s*(?:bus|box|bte)\s*\w+)?(?:,?\s*\d{{4,5}}\s+[A-ZÀ-ÖØ-Ý][\wÀ-ÖØ-öø-ÿ'’ -]+)?",
        r"(?i)(?:adres|address|adresse)\s*[:=-]\s*[^\n]{8,100}",
    ),
    "organization": (r"(?i)(?:werkgever|employer|organisation|organization|bedrijf)\s*[:=-]\s*[^\n,;]{2,80}",),
}
RESTRICTED = frozenset("belgian_national_number passport_number payment_card".split())
REIDENTIFYING = frozenset("person_name postal_address date_of_birth geographic_location organization ip_address".split())
REDACTABLE = frozenset("person_name email_address phone_number postal_address geographic_location date_of_birth iban ip_address".split())
#: Of findings of these types that overlap, the first in this order stays.
EXCLUSIVE = "belgian_national_number payment_card iban date_of_birth passport_number ip_address phone_number".split()
#: What a redacted span with several findings is named after.
LABELS = "belgian_national_number payment_card iban date_of_birth passport_number email_address ip_address phone_number postal_address person_name geographic_location card_like".split()


def only_digits(x: str) -> str:
    return "".join(c for c in x if c.isdigit())


def valid_national(x: str) -> bool:
    """Belgian number: a date in either century and the check digits of either."""
    d = only_digits(x)
    if len(d) != 11 or d[6:9] == "000":
        return False
    for century in (1900, 2000):
        with contextlib.suppress(ValueError):
            datetime.date(century + int(d[:2]), int(d[2:4]), int(d[4:6]))
            return int(d[9:]) in (97 - int(d[:9]) % 97, 97 - int("2" + d[:9]) % 97)
    return False


def valid_card(x: str) -> bool:
    d = only_digits(x)
    return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def valid_iban(x: str) -> bool:
    x = "".join(c for c in x if c.isalnum()).upper()
    if not 15 <= len(x) <= 34 or not x[:2].isalpha() or not x.isascii():
        return False
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def valid_ip(x: str) -> bool:
    try:
        ipaddress.ip_address(x.strip())
    except ValueError:
        return False
    return True


def valid_phone(x: str) -> bool:
    d = only_digits(x)
    return 8 <= len(d) <= 15 and len(set(d)) > 1 and not re.fullmatch(r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}", x.strip())


def valid_coordinates(x: str) -> bool:
    a, b = x.replace(";", ",").split(",")
    return -90 <= float(a) <= 90 and -180 <= float(b) <= 180


# What a text must have for a pattern to match, in lower case: one of these words, and a place like this. Both are cheaper to look for.
DIGIT_RUN = r"\d(?:[ .()/-]?\d){7}"
STREETS = "straat laan weg plein kaai dreef markt rue avenue boulevard chauss".split()
NEEDS = {
    EMAIL: ("@", None), NATIONAL: ("", DIGIT_RUN), CARD: ("", DIGIT_RUN), PHONE: ("", DIGIT_RUN), IBAN_BE: ("be", DIGIT_RUN), IBAN: ("", r"\d\d\w{11}"),
    BORN: ("geboren geboortedatum naissance born birth geburtsdatum", r"\d[./-]\d"), PASSPORT: ("passport paspoort passeport reisepass", None),
    IP: ("", r":[0-9a-f]{0,4}:|\d\.\d{1,3}\.\d"), COORDINATES: ("", r"\.\d{4}"),
    PHRASES["person_name"][0]: ("naam name nom patient patiënt client", r"(?:naam|name|nom|pati[eë]nt|client)\s*[:=-]"),
    PHRASES["person_name"][1]: ("mr mrs ms dr meneer mevrouw monsieur madame", r"(?:mr|mrs|ms|dr|meneer|mevrouw|monsieur|madame)\.?\s"),
    PHRASES["postal_address"][0]: (" ".join(STREETS), rf"(?:{'|'.join(STREETS)})(?:[eé]e)?\s+\d"),
    PHRASES["postal_address"][1]: ("adres address", r"(?:adres|address|adresse)\s*[:=-]"),
    PHRASES["organization"][0]: ("werkgever employer organisation organization bedrijf", r"(?:werkgever|employer|organisation|organization|bedrijf)\s*[:=-]"),
}
#: Characters that Python takes for s and i when case is ignored, and the dot that lower case leaves of the last.
ALIKE = {0x17F: "s", 0x131: "i", 0x307: None}


def plain_case(text: str) -> str:
    """Lower case in which everything that a pattern without case may match has the pattern's letters."""
    return text.lower() if text.isascii() else text.lower().translate(ALIKE)


#: Type, pattern, group of the value, what else it must be, and what the text must have.
DETECTORS = [
    (kind, re.compile(p), group, ok, tuple(NEEDS[p][0].split()), NEEDS[p][1] and re.compile(NEEDS[p][1]))
    for kind, p, group, ok in (
        ("email_address", EMAIL, 0, None),
        ("belgian_national_number", NATIONAL, 0, valid_national),
        ("payment_card", CARD, 0, valid_card),
        ("iban", IBAN_BE, 0, valid_iban),
        ("iban", IBAN, 0, valid_iban),
        ("date_of_birth", BORN, 1, None),
        ("passport_number", PASSPORT, 1, None),
        ("ip_address", IP, 0, valid_ip),
        ("phone_number", PHONE, 0, valid_phone),
        ("geographic_location", COORDINATES, 0, valid_coordinates),
        *((kind, p, 0, None) for kind, found_by in PHRASES.items() for p in found_by),
    )
]


def detectors(text: str) -> list[tuple]:
    """Those that may find something in the text: type, pattern, group, check."""
    low, hints, out = plain_case(text), {}, []
    for *detector, words, hint in DETECTORS:
        if words and not any(w in low for w in words):
            continue
        if hint and hint not in hints:
            hints[hint] = hint.search(low) is not None
        if not hint or hints[hint]:
            out.append(detector)
    return out


def findings(text: str) -> list[tuple[str, int, int]]:
    """Type, start and end of what identifies someone. Of overlapping structured findings the first by EXCLUSIVE stays; a phrase
    counts as its whole sentence."""
    out: set[tuple[str, int, int]] = set()
    for kind, pattern, group, ok in detectors(text):
        for m in pattern.finditer(text):
            if ok and not ok(m[group]):
                continue
            start, end = m.span(group)
            if kind in PHRASES:
                left = max(text.rfind(".", 0, start), text.rfind("\n", 0, start)) + 1
                start, end = min(left, start), max(end, min((p for p in (text.find(".", end), text.find("\n", end)) if p >= 0), default=len(text) - 1) + 1)
            out.add((kind, start, end))
    kept: list[tuple[int, int]] = []
    selected = [x for x in out if x[0] not in EXCLUSIVE]
    for kind, start, end in sorted((x for x in out if x[0] in EXCLUSIVE), key=lambda x: (EXCLUSIVE.index(x[0]), x[1], -x[2])):
        at = bisect.bisect_left(kept, (end,))
        if at and kept[at - 1][1] > start:
            continue
        bisect.insort(kept, (start, end))
        selected.append((kind, start, end))
    return sorted(selected, key=lambda x: (x[1], x[0]))


def types_of(text: Column) -> Column:
    """Sorted types of the findings."""
    return F.arrow_udf(lambda texts: pa.array([sorted({x[0] for x in findings(t or "")}) for t in texts.to_pylist()], pa.list_(pa.string())), "array<string>")(text)


def redacted_text(text: str) -> str:
    """Redactable findings, cards and all runs of digits that look like one replaced by their kind; overlapping ones together."""
    cards = re.finditer(CARD, text) if re.search(DIGIT_RUN, text) else ()
    spans = [x for x in findings(text) if x[0] in REDACTABLE or x[0] == "payment_card"] + [("card_like", *m.span()) for m in cards]
    groups: list[list] = []
    for kind, start, end in sorted(spans, key=lambda x: (x[1], x[2])):
        if groups and start < groups[-1][2]:
            groups[-1][0] = min(groups[-1][0], kind, key=LABELS.index)
            groups[-1][2] = max(groups[-1][2], end)
        else:
            groups.append([kind, start, end])
    for kind, start, end in reversed(groups):
        text = f"{text[:start]}[REDACTED_{'PAYMENT_CARD' if kind == 'card_like' else kind.upper()}]{text[end:]}"
    return text


def redacted(text: Column) -> Column:
    return F.arrow_udf(lambda texts: pa.array([redacted_text(t or "") for t in texts.to_pylist()], pa.string()), "string")(text)
