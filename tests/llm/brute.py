"""Plain versions of the operators' contracts, for comparison on small inputs."""

import hashlib
import re

BASE_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: card_ok(re.sub("[^0-9]", "", m.group()))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15),
}
BASE_SECRETS = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: len(m.group(2)) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
}


def card_ok(digits):
    if not 12 <= len(digits) <= 19:
        return False
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text, kinds):
    out = []
    for order, (kind, (pattern, ok)) in enumerate(kinds.items()):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def words(text):
    """Lower-cased words of letters, digits and anything beyond ASCII."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
