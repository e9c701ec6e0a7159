"""Names typed by people: tokens, edit neighbourhoods and alignment. Plain Python, used inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

#: Generational suffixes and surname particles.
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "2nd": "ii", "iii": "iii", "3rd": "iii", "iv": "iv", "4th": "iv", "v": "v"}
PARTICLES = frozenset("de del della der den di da du la le van von st saint".split())
#: Letters that accent removal doesn't reach.
PLAIN_LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "æ": "ae", "œ": "oe", "ß": "ss", "ı": "i", "þ": "th"})
#: Digits typed for the letters they resemble.
SLIPPED_DIGITS = str.maketrans("015", "ols")
#: Common English short forms that are no prefix of the full name.
NICKNAMES = {
    "alexander": "xander sandy lex", "andrew": "drew andy", "anthony": "tony", "benjamin": "benny", "charles": "chuck charlie chip",
    "christopher": "kit", "daniel": "danny", "david": "davey dave", "demetrius": "meech", "dominic": "nick", "donovan": "donny",
    "edward": "ted ned eddie", "elijah": "lije", "emmanuel": "manny", "ezekiel": "zeke", "francis": "frank", "frederick": "freddy freddie",
    "gabriel": "gabe", "gerald": "jerry", "gregory": "gregg", "harold": "harry hal", "henry": "hank harry", "isaiah": "zay ike", "jacob": "jake",
    "james": "jim jimmy jamie", "jeremiah": "jerry jay", "john": "jack johnny", "jonathan": "johnny", "joseph": "joey joe", "julius": "juju jules", "joshua": "josh",
    "kenneth": "kenny", "lawrence": "larry", "leonard": "lenny", "marcus": "marc mark", "matthew": "matty", "maximilian": "maxi",
    "michael": "mike mikey mick mickey", "nathaniel": "nate", "nicholas": "nick nicky nico", "patrick": "paddy", "phillip": "pip", "raymond": "rayray",
    "reginald": "reggie", "richard": "rick dick ricky", "robert": "bob bobby robbie", "ronald": "ronnie", "samuel": "sammy", "sebastian": "bash",
    "stephen": "steve stevie", "terrence": "terry", "theodore": "ted teddy theo", "thomas": "tom tommy", "timothy": "timmy", "tyrell": "rell",
    "vincent": "vinny", "walter": "wally", "william": "bill billy willie", "xavier": "zay", "zachary": "zack zak",
}
FULL_NAMES: dict[str, tuple[str, ...]] = {}
for _full, _short in NICKNAMES.items():
    for _one in _short.split():
        FULL_NAMES[_one] = (*FULL_NAMES.get(_one, ()), _full)

#: Spellings that sound alike, applied in this order.
SOUNDS = (("qu", "kw"), ("sch", "sh"), ("ph", "f"), ("x", "ks"), ("ck", "k"), ("kk", "k"), ("y", "i"), ("z", "s"), ("w", "v"), ("c", "k"))

#: Kinds of token agreement, best first, with the share of a whole match that each is worth.
WORTH = {"same": 1.0, "typo": 0.85, "short": 0.85, "typos": 0.7, "initial": 0.5, "other": 0.05}


def fold(text: str) -> str:
    """Lower case without accents."""
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c)).lower().translate(PLAIN_LETTERS)


def tokens(name: str | None) -> tuple[tuple[str, ...], str]:
    """Core tokens in the order typed, and the suffix ('' if none).

    Apostrophes, points and hyphens join what they stand between; particles
    join the token after them.
    """
    if not name:
        return (), ""
    suffix, core, held = "", [], ""
    for word in re.split(r"[\s,;/]+", fold(name)):
        pointed = word.endswith(".")
        word = re.sub(r"[^\w]|_", "", word)
        if not word:
            continue
        if word not in SUFFIXES and not word.isdigit():
            word = word.translate(SLIPPED_DIGITS)
        if word in SUFFIXES and (core or held):
            suffix = SUFFIXES[word]
        elif word in PARTICLES and (not pointed or word == "st"):
            held += word
        else:
            core.append(held + word)
            held = ""
    if held:
        core.append(held)
    return tuple(core), suffix


def sound(token: str) -> str:
    """The token with spellings that sound alike made equal."""
    for written, heard in SOUNDS:
        token = token.replace(written, heard)
    return token


def edit_distance(a: str, b: str, most: int = 2) -> int:
    """Optimal string alignment distance (insert, delete, replace, swap neighbours), or ``most + 1`` if greater."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def name_key(name: str | None) -> str:
    """Equal for names with the same tokens in any order, case and accents, and the same suffix."""
    core, suffix = tokens(name)
    return " ".join([*sorted(core), *([suffix] if suffix else [])])


def deletes(token: str, depth: int = 1) -> set[str]:
    """The token and all strings left after deleting up to ``depth`` letters: two tokens within that distance share one."""
    found = level = {token}
    for _ in range(depth):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t)) if len(t) > 2}
        found = found | level
    return found


def token_kind(a: str, b: str) -> str | None:
    """How two tokens agree: same, typo, short (abbreviation, nickname or half), typos, initial, or not at all."""
    if a == b:
        return "same"
    short, long = sorted((a, b), key=len)
    if len(short) <= 2:
        if long[0] == short[0] and (len(short) == 1 or long.startswith(short)):
            return "initial"
        if len(short) == 1:
            known_as = (*FULL_NAMES.get(long, ()), *NICKNAMES.get(long, "").split())
            return "initial" if any(n[0] == short for n in known_as) else None
        if len(long) <= 3 and short[0] == long[0] and edit_distance(short, long) == 1:
            return "typos"
        return "typo" if len(long) == 2 and short == long[::-1] else None
    if long.startswith(short) or long.endswith(short) or long in FULL_NAMES.get(short, ()) or short in FULL_NAMES.get(long, ()):
        return "short"
    distance = edit_distance(a, b)
    if distance == 1:
        return "typo"
    if distance == 2 and (len(short) >= 6 or len(short) >= 4 and sorted(short) == sorted(long)):
        return "typos"
    if len(short) >= 5 and edit_distance(sound(short), sound(long), 1) <= 1:
        return "typos"
    if len(short) <= 4 < len(long) and edit_distance(short, long[: len(short)]) == 1:
        return "typos"  # an abbreviation with a slip in it
    if any(edit_distance(long, f) == 1 for f in FULL_NAMES.get(short, ())):
        return "typos"  # a nickname of a name with a slip in it
    return None


#: What each kind of agreement takes from the worth of a name, and what a letter left without a partner takes.
COST = {"same": 0.0, "short": 1.0, "typo": 1.5, "typos": 2.5, "initial": 3.0, "other": 7.0}
OVER_COST, CROSSED_COST = 0.5, 4.0
#: Stands for a pair that may not be; greater than any sum of costs of pairs that may.
FORBIDDEN = 1e6
#: Counts before any other cost: pairs that disagree altogether are as few as can be.
OTHER_FIRST = 1e3


#: Caches of a process; what they forget is computed again.
_KINDS: dict[tuple[str, str], str | None] = {}
_ENTRIES: dict[str, tuple[set[str], set[str], set[str]]] = {}
_MOST_CACHED = 100_000


def _kind(a: str, b: str) -> str | None:
    if (a, b) not in _KINDS:
        if len(_KINDS) > _MOST_CACHED:
            _KINDS.clear()
        _KINDS[a, b] = token_kind(a, b)
    return _KINDS[a, b]


def least_cost(cost: np.ndarray) -> tuple[float, list[int]]:
    """Least total and the column of each row of a square cost matrix, by the Hungarian method with row potentials."""
    n = len(cost)
    u, v = np.zeros(n + 1), np.zeros(n + 1)
    matched, way = np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int)  # row of each column, 1-based; 0 is none
    for i in range(1, n + 1):
        matched[0], j0 = i, 0
        least, used = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=bool)
        while matched[j0]:
            used[j0] = True
            row = matched[j0]
            current = cost[row - 1] - u[row] - v[1:]
            better = ~used[1:] & (current < least[1:])
            least[1:][better], way[1:][better] = current[better], j0
            j1 = int(np.argmin(np.where(used, np.inf, least)[1:])) + 1
            delta = least[j1]
            u[matched[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
        while j0:
            matched[j0], j0 = matched[way[j0]], way[j0]
    columns = [0] * n
    for j in range(1, n + 1):
        columns[matched[j] - 1] = j - 1
    return float(sum(cost[i, j] for i, j in enumerate(columns))), columns


def _all_ways(pairs: list[list[tuple[float, str]]], spare_a: list[float], spare_b: list[float]) -> tuple[float, list[int]]:
    """Least total and the partner of each row (the number of columns for none) over all assignments."""
    n, m = len(pairs), len(spare_b)
    best: tuple[float, list[int]] = (FORBIDDEN, [m] * n)

    def go(i: int, cost: float, chosen: list[int]) -> None:
        nonlocal best
        if cost >= best[0]:
            return
        if i == n:
            total = cost + sum(spare_b[j] for j in range(m) if j not in chosen)
            if total < best[0]:
                best = (total, chosen)
            return
        for j in range(m):
            if j not in chosen:
                go(i + 1, cost + pairs[i][j][0], [*chosen, j])
        go(i + 1, cost + spare_a[i], [*chosen, m])

    go(0, -1.0, [])  # costs of equal tokens are a hair below zero
    return best[0] + 1.0, best[1]


def _assign(a: tuple[str, ...], b: tuple[str, ...], others: int, joined: str = "") -> tuple[float, dict[str, int]] | None:
    """Assignment of least cost for ``len(a) <= len(b)``; up to ``others`` pairs may disagree altogether.

    Single letters may stay without a partner. ``joined`` is a token made of
    two: it must agree as a whole, not in a part.
    """

    def pair(x: str, y: str) -> tuple[float, str]:
        kind = _kind(x, y)
        if joined and joined in (x, y) and kind in ("short", "initial"):
            kind = None
        if kind is None:
            return (OTHER_FIRST + COST["other"], "other") if others and min(len(x), len(y)) >= 3 else (FORBIDDEN, "other")
        return COST[kind] - 1e-6 * WORTH[kind] * max(len(x), len(y)), kind  # of equal costs, the one that more letters carry

    n, m = len(a), len(b)
    if sum(len(y) > 1 for y in b) > n or not m:
        return None  # a token of weight stays over
    pairs = [[pair(x, y) for y in b] for x in a]
    spare_a = [OVER_COST + CROSSED_COST if len(x) == 1 else FORBIDDEN for x in a]
    spare_b = [OVER_COST if len(y) == 1 else FORBIDDEN for y in b]
    if n <= 3:  # the usual name: all ways are tried, which is quicker
        total, chosen = _all_ways(pairs, spare_a, spare_b)
    else:
        cost = np.zeros((n + m, n + m))
        cost[:n, :m] = [[c for c, _ in row] for row in pairs]
        cost[:n, m:] = np.array(spare_a)[:, None]
        cost[n:, :m] = np.array(spare_b)[None, :]
        total, chosen = least_cost(cost)
        chosen = chosen[:n]
    if total >= FORBIDDEN / 2:
        return None
    counts: dict[str, int] = {}
    left = 0
    for i, j in enumerate(chosen):
        if j >= m:
            left += 1
        else:
            counts[pairs[i][j][1]] = counts.get(pairs[i][j][1], 0) + 1
    if counts.get("other", 0) > others or not counts:
        return None
    counts |= {"over": 2 * left + m - n, "crossed": left}
    return sum(COST[k] * c for k, c in counts.items() if k in COST) + OVER_COST * counts["over"] + CROSSED_COST * left, counts


def align(a: tuple[str, ...], b: tuple[str, ...], others: int = 0) -> tuple[float, dict[str, int]] | None:
    """One-to-one assignment of the tokens at the least cost, or None if a token of weight stays without a partner.

    Single letters (middle initials) may stay over; two neighbouring tokens may
    stand for one written together. Names may have any number of tokens.
    Returns the cost and the number of pairs of each kind; 'over' counts
    left-over initials and 'crossed' initials that contradict each other.
    """
    if not a or not b:
        return None
    if len(a) > len(b):
        a, b = b, a
    if a == b:
        return 0.0, {"same": len(a), "over": 0, "crossed": 0}
    best = _assign(a, b, others)
    if best is None and len(b) > 1:
        joined = [((*b[:i], b[i] + b[i + 1], *b[i + 2 :]), b[i] + b[i + 1]) for i in range(len(b) - 1)]
        found = [_assign(*sorted((a, tokens_), key=len), others, pair) for tokens_, pair in joined]
        if not any(found) and len(a) > 1:
            # half of a double name may be missing, if all the rest has its partner
            partly = [_assign(*sorted((a, tokens_), key=len), others) for tokens_, _ in joined]
            found = [f for f in partly if f and not f[1]["over"]]
        best = min((f for f in found if f), key=lambda f: f[0], default=None)
    return best


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _shortened(token: str) -> set[str]:
    """The token and what is left of it after one deletion, as typed and as it sounds."""
    heard = sound(token)
    return {x[:i] + x[i + 1 :] for x in (token, heard) for i in range(len(x)) if len(x) > 1} | {token, heard}


def _heads(token: str) -> set[str]:
    """Marks of a token that it shares with each of its short forms: three letters at either end, and those of its full names."""
    return {"<" + token[:3], ">" + token[-3:], *("<" + f[:3] for f in FULL_NAMES.get(token, ()))}


def _ends(token: str) -> set[str]:
    """Symmetric-delete neighbourhood of both ends of a token, as typed, as it sounds, and of its full names.

    Tokens of six letters and more within two edits have one end of three
    letters with one edit at most; tokens within one edit, and short forms with a
    slip, have such a beginning.
    """
    found = set()
    for x in (token, sound(token), *FULL_NAMES.get(token, ())):
        for mark, end in (("<", x[:3]), (">", x[-3:])):
            found |= {mark + end, *(mark + end[:i] + end[i + 1 :] for i in range(len(end)) if len(end) > 1)}
    return found | {"=" + "".join(sorted(token))} if len(token) in (4, 5) else found


def token_entries(token: str) -> tuple[set[str], set[str], set[str]]:
    """Whole-token neighbourhood at depth 1, neighbourhood of the ends, and heads."""
    if token not in _ENTRIES:
        if len(_ENTRIES) > _MOST_CACHED:
            _ENTRIES.clear()
        _ENTRIES[token] = (_shortened(token), _ends(token), _heads(token))
    return _ENTRIES[token]


def index_entries(name_key: str) -> tuple[list[int], list[int], list[int]]:
    """Hashed index entries of a name: near, ends, exact.

    near
        a common entry for any two names with a token in common that is the
        same, one edit off or sounds so; with two tokens that are both short
        forms of the other's; or, for names of one token, with anything that
        ``token_kind`` lets carry a match. A name whose two tokens another writes
        as one is found while its first or last three letters are intact.
    ends
        a common entry for any two names with a pair of tokens that
        ``token_kind`` calls same, typo, typos or short.
    exact
        a common entry for any two names with the same token, with two tokens
        that are both short forms, or names of one token as near has them.
    """
    core, _ = tokens(name_key)
    weighty = [t for t in core if len(t) > 1]
    each = [token_entries(t) for t in core]
    near = set().union(*(e[0] for e in each)) if each else set()
    ends = set().union(*(e[1] for e in each)) if each else set()
    exact = {"=" + t for t in core}
    both: set[str] = set()
    if len(weighty) <= 8:
        heads = [token_entries(t)[2] for t in weighty]
        both = {"+".join(sorted((x, y))) for i, one in enumerate(heads) for other in heads[i + 1 :] for x in one for y in other}
    if len(weighty) >= 8:  # of many tokens, each one's heads: what pairs of heads find, these find
        both |= {"8" + x for t in weighty for x in token_entries(t)[2]}
    if len(weighty) == 1:
        both = {"1" + x for x in token_entries(weighty[0])[1]}
    elif len(weighty) == 2:  # written as one token elsewhere
        both |= {"1<" + weighty[0][:3], "1>" + weighty[1][-3:]}
    return [_hash(x) for x in near | both], [_hash(x) for x in ends], [_hash(x) for x in exact | both]
