"""The small labelled table that the tagger of personal data is fitted to: sentences with slots, filled by rule."""

import random

# Sentences. A slot in brackets holds personal data of its kind, <number> a number that is none.
SENTENCES = [
    "call me on {phone} after noon", "tel: {phone}", "phone {phone}, ask for the desk", "our fax is {phone}.", "ring {phone} or {phone}",
    "the office ({phone}) is open", "téléphone {phone} le matin", "telefon {phone} bitte", "teléfono {phone} gracias", "{phone}", "reach us {phone} today",
    "write to {email} please", "email: {email}", "contact {email}, or {phone}", "<{email}>", "{email}", "mail {email} and {email}.", "ask {email} about it",
    "from {ip} at night", "host {ip} is down", "ping {ip}, then {ip}", "server {ip}: refused", "{ip}", "the address {ip} was seen",
    "card {card} was charged", "visa {card}, thanks", "paid by {card} yesterday", "{card}", "credit card {card}.", "karte {card} gesperrt",
    "built in <number> by hand", "about <number> of them", "see <number>, then <number>", "version <number> is out", "on <number> we met", "order <number> was sent",
    "from <number> to <number>", "<number>", "at <number> sharp", "copyright <number> the authors", "call <number> of <number>", "page <number> of card <number>",
    "the host has <number> users", "token = \"<number>\" here", "item <number> (<number>) and <number>", "follow <handle> there", "a score of <number> in <number>",
    "tel <number> x", "mail <handle> on <number>", "server <number> and <number> again",
]
WORDS = ["alder", "birch", "cedar", "dogwood", "elm", "fir", "ginkgo", "hazel", "iris", "juniper", "kauri", "larch"]
ENDS = ["com", "org", "net", "de", "fr", "es", "co.uk", "example.com"]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _first(rng: random.Random, n: int) -> str:
    return rng.choice("123456789") + _digits(rng, n - 1)


def phone(rng: random.Random) -> str:
    d = lambda n: _digits(rng, n)
    f = lambda n: _first(rng, n)
    return rng.choice([
        lambda: f"+1 ({f(3)}) {f(3)}-{d(4)}", lambda: f"({f(3)}) {f(3)}-{d(4)}", lambda: f"{f(3)}-{f(3)}-{d(4)}", lambda: f"{f(3)}.{f(3)}.{d(4)}",
        lambda: f"0{f(2)} {d(4)} {d(4)}", lambda: f"0{f(3)} {d(3)} {d(4)}", lambda: f"+{f(2)} {f(2)} {d(4)} {d(4)}", lambda: f"0{f(1)} {d(2)} {d(2)} {d(2)} {d(2)}",
        lambda: f"00 {f(2)} {f(2)} {d(6)}", lambda: f"0{f(2)}/{d(6)}", lambda: f"1-{f(3)}-{f(3)}-{d(4)}", lambda: f"{f(3)} {f(3)} {d(4)}",
        lambda: f"+{f(2)}{d(9)}", lambda: f"({f(3)}){f(3)}-{d(4)}",
    ])()


def email(rng: random.Random) -> str:
    user = rng.choice(WORDS) + rng.choice(["", ".", "_", "-"]) + rng.choice([*WORDS, _digits(rng, 2)])
    host = rng.choice(WORDS) + rng.choice(["", _digits(rng, 1)]) + "." + rng.choice(ENDS)
    return rng.choice([f"{user}@{host}", f"{user}@{host}", f"{user}(at){host}", f"{user}[at]{host}", f"josé@{host}", f"{user}@mü{host}", f"Zoë.{user.title()}é@{host}"])


def ip(rng: random.Random) -> str:
    parts = [str(rng.randrange(256)) for _ in range(4)]
    groups = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
    return rng.choice([".".join(parts), ".".join(parts), "[.]".join(parts), "(.)".join(parts), ":".join(groups), "2001:db8::" + groups[0], f"fe80::{groups[1]}:{groups[2]}"])


def card(rng: random.Random) -> str:
    size = rng.choice([16, 16, 16, 15])
    digits = rng.choice("3456") + _digits(rng, size - 2)
    values = [int(c) for c in digits[::-1]]
    total = sum(values[1::2]) + sum(2 * v - 9 * (v > 4) for v in values[0::2])
    digits += str(-total % 10)
    if size == 15:
        return rng.choice([digits, f"{digits[:4]} {digits[4:10]} {digits[10:]}", f"{digits[:4]}.{digits[4:10]}.{digits[10:]}"])
    return rng.choice(["", " ", "-", ".", "."]).join(digits[k:k + 4] for k in range(0, 16, 4))


def number(rng: random.Random) -> str:
    """Numbers that look like others do: years, dates, times, versions, prices, codes, keys and counts."""
    d = lambda n: _digits(rng, n)
    two = lambda n: f"{rng.randrange(1, n):02d}"
    year = str(rng.randrange(1900, 2030))
    return rng.choice([
        lambda: year, lambda: f"{year}-{two(13)}-{two(29)}", lambda: f"{two(29)}/{two(13)}/{year}", lambda: f"{two(29)}.{two(13)}.{year}", lambda: f"{year}-{year}",
        lambda: f"{two(24)}:{two(60)}", lambda: f"{two(24)}:{two(60)}:{two(60)}", lambda: f"v{rng.randrange(9)}.{rng.randrange(30)}.{rng.randrange(30)}",
        lambda: f"{rng.randrange(9)}.{rng.randrange(30)}.{rng.randrange(30)}", lambda: f"{rng.randrange(90)}.{d(2)}", lambda: f"${rng.randrange(1, 99)},{d(3)}.{d(2)}",
        lambda: str(rng.randrange(1, 99)), lambda: str(rng.randrange(100, 9999)), lambda: _first(rng, rng.choice([5, 6, 7, 8, 10])), lambda: f"#{_first(rng, 5)}",
        lambda: f"{rng.randrange(100)}.{d(1)}%", lambda: f"{rng.choice('ABCX')}{d(1)}-{d(4)}-{rng.choice('KQZ')}", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"3.{d(5)}", lambda: f"{rng.randrange(1, 30)}th", lambda: f"{two(90)}-{two(90)}", lambda: f"{rng.randrange(1, 9)}e{rng.randrange(1, 9)}",
        lambda: f"{_first(rng, 5)}-{d(4)}", lambda: f"{_first(rng, 1)} {d(3)} {d(3)}", lambda: f"{_first(rng, 20)}", lambda: f"x{d(2)}", lambda: f"{d(1)},{d(1)}", lambda: f"({rng.randrange(1, 99)})",
    ])()


def handle(rng: random.Random) -> str:
    return rng.choice([f"@{rng.choice(WORDS)}", f"@{rng.choice(WORDS)}{_digits(rng, 2)}", f"{rng.choice(WORDS)}@{rng.choice(WORDS)}", "(at) home", "@"])


FILLERS = {"phone": phone, "email": email, "ip": ip, "card": card}


def examples(rows: int = 1_500, seed: int = 7) -> list[tuple[str, str]]:
    """(text, spans) rows: sentences in turn, their slots filled with values that the seed decides."""
    rng, out = random.Random(seed), []
    for k in range(rows):
        text, spans = "", []
        for piece in SENTENCES[k % len(SENTENCES)].replace("<number>", "{number}").replace("<handle>", "{handle}").split("{"):
            name, closed, rest = piece.partition("}")
            if not closed:
                text += piece
                continue
            value = number(rng) if name == "number" else handle(rng) if name == "handle" else FILLERS[name](rng)
            if name in FILLERS:
                spans.append(f"{name}:{len(text)}:{len(text) + len(value)}")
            text += value + rest
        out.append((text, ",".join(spans)))
    return out
