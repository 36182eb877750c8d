"""Planted spans: values of a kind of personal data set into texts, with their truth.

A plant has a lead, a value and a truth.  Personal ones are well formed and stand after a
word of their kind or after none, or have a wrong digit and stand after such a word.  The
others have the same formats, valid check digits included, after words that tell of orders,
versions and the like, or are malformed after none.  All choices come from the given
generator, so a seed gives the same plants everywhere.
"""

from __future__ import annotations

import random
import string

# Leads and name endings.
LEADS = {
    "ssn": ("ssn ", "ssn: ", "the ssn ", "social security number ", "social security no. ", "tax id "),
    "number": (
        "call ", "call me at ", "phone ", "phone: ", "tel. ", "tel: ", "Telefon ", "mobile ", "Handy ", "fax ", "téléphone ",
        "appelez le ", "teléfono ", "llame al ", "account ", "Konto ", "compte ", "cuenta ",
    ),
    "secret": (
        "token = ", 'token = "', "token: ", "api_key=", "api key: ", "secret = ", "secret: ", "password: ", "passwort: ", "key: ",
        "auth_token=", "Authorization: Bearer ", "clave: ", "mot de passe : ",
    ),
    "mailtext": ("write to ", "mail ", "mail: ", "contact ", "e-mail ", "schreib an ", "écrivez à ", "escriba a "),
    "card_like": ("card ", "cards ", "card number ", "card no. ", "visa ", "mastercard ", "pay with ", "Karte ", "carte ", "tarjeta "),
    "phone_like": ("call ", "phone ", "tel. ", "Telefon ", "mobile ", "fax ", "téléphone ", "llame al "),
}
OTHER = (
    "order ", "order no. ", "order number ", "invoice ", "item ", "ref ", "version ", "build ", "tracking ", "serial ", "ISBN ", "total ", "part ",
    "batch ", "Bestellung ", "Rechnung ", "Artikel ", "commande ", "facture ", "pedido ", "factura ",
)
OTHER_TOKEN = ("commit ", "build ", "version ", "file ", "sha1 ", "item ", "part ", "order ", "ref ", "batch ")
ENDINGS = ("com", "org", "net", "de", "fr", "es", "io", "eu", "info")


def word(rng: random.Random, least: int = 2, most: int = 9) -> str:
    return "".join(rng.choices(string.ascii_lowercase, k=rng.randint(least, most)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def digits(rng: random.Random, n: int) -> str:
    return str(rng.randint(1, 9)) + "".join(rng.choices(string.digits, k=n - 1))


def snippet(rng: random.Random, text: str) -> tuple[str, str]:
    """Up to 80 and 40 characters around a place of the text, cut at blanks where there are some."""
    at = rng.randint(0, len(text))
    before, after = text[max(0, at - 80) : at], text[at : at + 40]
    return before[: before.rfind(" ") + 1].rstrip(), after[after.find(" ") + 1 :] if " " in after else ""


def grouped(rng: random.Random, value: str, sizes: tuple[int, ...], signs: str = " -") -> str:
    sign, parts = rng.choice(signs), []
    for n in sizes:
        parts.append(value[:n])
        value = value[n:]
    return sign.join([p for p in [*parts, value] if p])


def card(rng: random.Random, valid: bool) -> str:
    """14 to 19 digits, mostly 16, whose check digit is right or wrong, in fours or as one group."""
    body = digits(rng, rng.choice((13, 14, 15, 15, 15, 15, 18)))
    total = 0
    for i, d in enumerate(reversed(body)):
        total += sum(divmod(int(d) * (2 - i % 2), 10))
    check = -total % 10
    value = body + str(check if valid else (check + rng.randint(1, 9)) % 10)
    return grouped(rng, value, (4, 4, 4)) if rng.random() < 0.3 else value


def social(rng: random.Random, valid: bool) -> str:
    area = rng.choice((rng.randint(1, 665), rng.randint(667, 899))) if valid else rng.choice((0, 666, rng.randint(900, 999)))
    return f"{area:03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"


def phone(rng: random.Random) -> str:
    """A plain number as people write them."""
    shape = rng.randrange(5)
    if shape == 0:
        return "0" + digits(rng, rng.randint(7, 10))
    if shape == 1:
        return grouped(rng, digits(rng, 10), (3, 3))
    if shape == 2:
        return f"0{digits(rng, rng.randint(2, 3))} {digits(rng, rng.randint(6, 7))}"
    if shape == 3:
        return grouped(rng, "0" + digits(rng, 9), (2, 2, 2, 2))
    return digits(rng, rng.randint(7, 12))


def token(rng: random.Random) -> str:
    signs = rng.choice((string.ascii_letters + string.digits, string.ascii_letters + string.digits, string.hexdigits[:16]))
    while True:
        value = "".join(rng.choices(signs, k=rng.randint(16, 44)))
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            return value


def known_token(rng: random.Random) -> str:
    if rng.random() < 0.5:
        return "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16))
    return rng.choice(("ghp_", "gho_", "sk_", "sk-")) + "".join(rng.choices(string.ascii_letters + string.digits, k=36))


def address(rng: random.Random, personal: bool) -> str:
    """A spelled-out address, or words that only look like one."""
    if not personal:
        return f"{word(rng)} at {word(rng)} dot {word(rng, 3, 8)}"
    local = rng.choice((word(rng), f"{word(rng)}.{word(rng)}", f"{word(rng)}{rng.randint(1, 99)}", f"{word(rng)}_{word(rng)}"))
    at, dot = rng.choice((("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", " dot "), (" (at) ", " (dot) ")))
    return f"{local}{at.strip() + ' ' if at == ' (at) ' else at}{word(rng, 3, 10)}{dot}{rng.choice(ENDINGS)}"


def values(rng: random.Random, kind: str, personal: bool) -> tuple[str, list[str], str]:
    """Lead, the planted values (set apart by blanks) and what follows them at once."""
    told = rng.random() < 0.6
    lead = rng.choice(LEADS[kind]) if told else ""
    other = rng.choice(OTHER) if rng.random() < 0.7 else ""
    if kind == "ssn":
        return (lead, [social(rng, not told or rng.random() < 0.7)], "") if personal else (other, [social(rng, bool(other) and rng.random() < 0.7)], "")
    if kind == "number":
        if personal:
            return rng.choice(LEADS[kind]), [phone(rng) for _ in range(rng.choice((1, 1, 2, 3)))], ""
        return other, [rng.choice((phone(rng), digits(rng, rng.randint(7, 17)))) for _ in range(rng.choice((1, 1, 2)))], ""
    if kind == "secret":
        if personal and told:
            return lead, [token(rng)], '"' if lead.endswith('"') else ""
        if personal:
            return "", [known_token(rng)], ""
        names = f"{word(rng, 5)}_{rng.randint(1, 2030)}_{word(rng, 5)}_{word(rng, 5)}"
        return (rng.choice(OTHER_TOKEN) if other else ""), [token(rng) if rng.random() < 0.7 else names], ""
    if kind == "mailtext":
        return (lead if personal else ""), [address(rng, personal)], ""
    if kind == "card_like":
        if personal:
            if told and rng.random() < 0.5:
                return lead, [card(rng, False)], ""
            more = digits(rng, rng.randint(6, 12)) if rng.random() < 0.3 else ""
            return lead, [card(rng, True) for _ in range(1 if more else 2)], f" {more}" if more else ""
        if other:
            valid = rng.random() < 0.6
            return other, [card(rng, valid) for _ in range(rng.choice((1, 2)))], rng.choice(("", f" {digits(rng, 8)}"))
        return "", [card(rng, False) for _ in range(rng.choice((1, 1, 2)))], ""
    if personal:
        value = f"+{rng.randint(1, 99)} {rng.choice(('', '(0) '))}{digits(rng, rng.randint(2, 4))} {digits(rng, rng.randint(6, 7))}"
        return lead, [value], f" {digits(rng, rng.randint(9, 16))}"
    return other, ["+" + rng.choice((digits(rng, rng.randint(3, 8)), " ".join(digits(rng, 3) for _ in range(rng.randint(2, 8)))))], ""


def plant(rng: random.Random, kind: str, before: str, after: str) -> tuple[str, bool, set[tuple[int, int]]]:
    """The text with a plant of the kind, whether it is personal, and the planted spans."""
    personal = rng.random() < 0.5
    lead, planted, tail = values(rng, kind, personal)
    if not lead and rng.random() < 0.7:
        lead = word(rng) + " "
    text = f"{before} {lead}" if before else lead
    spans = set()
    for i, value in enumerate(planted):
        text += " " * (i > 0)
        spans.add((len(text), len(text) + len(value)))
        text += value
    return f"{text}{tail} {after}", personal, spans
