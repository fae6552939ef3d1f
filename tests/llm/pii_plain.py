"""Personal data replaced by plain Python loops over a list of texts, to compare the DataFrame version with."""
import hashlib

import regex

from verdant.llm import pii


def java(pattern):
    return regex.compile(pattern.replace(r"\d", "[0-9]"))


DETECT, BARE = java(pii.DETECT), java(pii.BARE)
KINDS = {k: java(p) for k, p in pii.KINDS.items()}
TITLE = java(rf"({pii.MEN}|{pii.WOMEN}|{pii.ANYONE}) ")


def digits(s):
    return "".join(c for c in s if c in "0123456789")


def luhn_digit(body):
    total = 0
    for i, c in enumerate(reversed(body)):
        total += sum(divmod(int(c) * 2, 10)) if i % 2 == 0 else int(c)
    return str(-total % 10)


def kind_of(m):
    for kind, pattern in KINDS.items():
        if pattern.fullmatch(m):
            return None if kind == "card" and luhn_digit(digits(m)[:-1]) != m[-1] else kind


def entities(m):
    """(kind, form, written, gender) of a match."""
    kind = kind_of(m)
    if kind is None:
        return []
    if kind == "name":
        title = TITLE.match(m).group(1)
        gender = "m" if java(pii.MEN).fullmatch(title) else "f" if java(pii.WOMEN).fullmatch(title) else ""
        *given, family = m[len(title) + 1:].split(" ")
        return [("given", w.lower(), w, gender) for w in given] + [("family", family.lower(), family, "")]
    form = m
    if kind in ("email", "secret"):
        form = m.lower()
    elif kind in ("ssn", "card"):
        form = digits(m)
    elif kind == "iban":
        form = m.replace(" ", "")
    elif kind == "phone":
        code = regex.match(r"\+([0-9]{1,3})(?=[^0-9])", m)
        code = code.group(1) if code else ""
        form = code + "|" + digits(m)[len(code):]
    return [(kind, form, m, "")]


def draw_from(seed, table):
    return "".join(table[int(c, 16)] for c in seed)


def shaped(text, seed):
    out = []
    for i, c in enumerate(text):
        for pattern, table in ((r"\p{N}", pii.DIGITS), (r"\p{IsCyrillic}", pii.CYRILLIC), (r"\p{IsGreek}", pii.GREEK), (r"\p{L}", pii.LATIN)):
            if regex.match(pattern, c):
                new = table[int(seed[i % 128], 16)]
                out.append(new.upper() if regex.match(r"\p{Lu}", c) else new)
                break
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind, form, draw, gender, key):
    seed = hashlib.sha512(f"{key}|{kind}|{form}|{draw}".encode()).hexdigest()
    number = draw_from(seed, pii.DIGITS)
    if draw < 0:
        return f"[{kind.upper()}-{seed[:32]}]"
    if kind == "email":
        return shaped(form.split("@")[0], seed) + "@mail" + number[99:101] + ".example.net"
    if kind == "ip":
        octet = lambda at: str(int(seed[at:at + 2], 16))
        return ".".join(["10" if draw < 3 else octet(6), octet(0), octet(2), octet(4)])
    if kind == "ssn":
        return "9" + number[:8]
    if kind == "phone":
        code, rest = form.split("|")
        return code + number[:len(rest)]
    if kind == "card":
        body = form[0] + number[1:len(form) - 1]
        return body + luhn_digit(body)
    if kind == "access_key":
        return form[:4] + draw_from(seed, pii.CAPITALS)[:16]
    if kind == "secret":
        return seed[:len(form)]
    if kind == "iban":
        rest = shaped(form[4:], seed)
        left = int("".join(str(int(c, 36)) for c in rest + form[:2] + "00")) % 97
        return f"{form[:2]}{98 - left:02d}{rest}"
    letters = next((t for p, t in ((r"\p{IsCyrillic}", pii.CYRILLIC), (r"\p{IsGreek}", pii.GREEK)) if regex.search(p, form)), pii.LATIN)
    a, b = draw_from(seed, letters), draw_from(seed, pii.VOWELS[letters])
    word = "".join(a[2 * i] + b[2 * i + 1] for i in range(4 if kind == "family" else 3))
    if kind == "given":
        word += {"f": pii.VOWELS[letters][0], "m": a[39], "": ""}[gender]
    return word.capitalize()


def assign(found, key, most_draws):
    told = {}
    for kind, form, gender in found:
        told.setdefault((kind, form), set()).update({gender} - {""})
    gender = {e: min(g) if len(g) == 1 else "" for e, g in told.items()}
    draw = dict.fromkeys(gender, 0)
    core = lambda e: surrogate(*e, draw[e], gender[e], key).lower()
    own = {(kind, form.replace("|", "")) for kind, form in gender}
    for turn in range(1, most_draws + 1):
        users = {}
        for e in draw:
            users.setdefault((e[0], core(e)), []).append(e)
        again = {e for (kind, c), es in users.items() for e in es
                 if (kind, c) in own or e != min(es, key=lambda e: (draw[e], e[1]))}
        if not again:
            break
        for e in again:
            draw[e] = -1 if turn == most_draws else draw[e] + 1
    return {e: (draw[e], gender[e]) for e in draw}


def render(kind, written, core, draw):
    if draw < 0:
        return core
    if kind in ("ssn", "phone", "card", "iban"):
        place = "[A-Z0-9]" if kind == "iban" else "[0-9]"
        chars = iter(core)
        return "".join(next(chars) if regex.match(place, c) else c for c in written)
    if kind in ("ip", "access_key"):
        return core
    capitals = written == written.upper() and len(written) > 1 and regex.search(r"\p{L}", written)
    return core.upper() if capitals else core


def replace_all(texts, key=pii.KEY, most_draws=pii.MOST_DRAWS):
    """(text, n_entities, n_bare) of each text."""
    found = [[(m, entities(m.group())) for m in DETECT.finditer(t or "")] for t in texts]
    known = assign({(k, f, g) for t in found for _, es in t for k, f, _, g in es}, key, most_draws)

    def new(kind, form, written):
        draw, gender = known[kind, form]
        return render(kind, written, surrogate(kind, form, draw, gender, key), draw)

    out = []
    for text, ms in zip(texts, found):
        names = {}
        for _, es in ms:
            for kind, form, _, _ in es:
                if kind == "family" or kind == "given" and form not in names:
                    names[form] = kind
        n_bare, parts, at = 0, [], 0

        def bare(m):
            nonlocal n_bare
            w = m.group()
            if w.lower() not in names:
                return w
            n_bare += 1
            return new(names[w.lower()], w.lower(), w)

        for m, es in ms:
            parts.append(BARE.sub(bare, text[at:m.start()]))
            title = TITLE.match(m.group()) if es and es[0][0] in ("given", "family") else None
            parts.append((title.group() if title else "") + " ".join(new(k, f, w) for k, f, w, _ in es) if es else m.group())
            at = m.end()
        parts.append(BARE.sub(bare, (text or "")[at:]))
        out.append((text if text is None else "".join(parts), sum(bool(es) for _, es in ms), n_bare))
    return out
