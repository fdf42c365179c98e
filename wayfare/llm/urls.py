"""URL filters: hand-set rules first, a logistic regression on hashed character n-grams for the rest.

The regression is trained here on a small labelled table of URLs; hosts and
paths give n-grams of their own. Rules are looked up by the host's suffixes.

Results in odd cases: a null url, or one without ``://``, has an empty host and
path, no rule, and the model's verdict on the empty url (allow). Repeated rows
give repeated rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from wayfare.llm.common import arrow_map, table

# The rules of the given task, (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# The labelled table is spelled out from these words: unwanted and wanted names of sites and sections.
UNWANTED = tuple((
    "casino poker bets free-bets jackpot slots lottery-win cheap-pills pills viagra pharma-deals spam spam-farm link-farm ads "
    "ads-track adserver tracker click-track popups porn xxx escort payday-loans fast-cash warez torrent-free crack-keys "
    "replica-watches seo-links "
    "online-casino betting sportsbet roulette blackjack bingo-win gambling vegas-slots lotto cialis weight-loss diet-pills "
    "cheap-meds adult adultchat sexcams hot-girls nude webcam-sex hookup loans quick-loans easy-money get-rich bitcoin-profit "
    "forex-bonus moneymaker free-iphone prizes winner-gift giveaway-win torrents cracked keygen serials free-download-full "
    "pirated streams-free replica-bags fake-watches backlinks buy-followers traffic-boost adclick popunder banner-ads "
    "trackpixel spyware phish-login verify-account malware").split())
WANTED = tuple((
    "news journal library university museum weather travel recipes garden history science health school books music sport "
    "city letters essays thoughts notes herald tribune archive wiki docs research nature theatre cinema "
    "times gazette chronicle observer courier daily-post review magazine radio television opera orchestra gallery arts design "
    "architecture photography painting poetry novels stories writers reading language dictionary grammar translation lessons "
    "college academy institute faculty students teachers laboratory physics chemistry biology mathematics geology astronomy "
    "ocean forest river mountain island village county region council parliament government justice hospital clinic medicine "
    "nursing family children parents kitchen cooking baking bread cheese coffee farm flowers birds animals horses fishing "
    "hiking cycling football cricket tennis rowing sailing railway airport harbour bridge museum-shop church cathedral castle "
    "heritage folklore economics finance industry engineering software developers opensource blog diary calendar events "
    "festival concert dance community society foundation charity volunteers housing energy climate environment "
    # Names of places and families, as hosts of shops, schools and people have them.
    "london paris berlin madrid vienna lisbon dublin oslo helsinki warsaw prague geneva hamburg munich leipzig dresden "
    "heidelberg tuebingen lyon bordeaux toulouse marseille sevilla valencia granada toledo bristol oxford cambridge norwich "
    "lincoln durham exeter plymouth preston bradford sheffield leicester richmond hamilton wellington auckland melbourne "
    "adelaide toronto ottawa boston chicago denver seattle portland austin houston memphis arlington springfield greenwood "
    "fairview riverside lakewood oakland cedarhill westfield northfield easton weston sutton newton milton clifton ashford "
    "johnson williams miller davis wilson anderson thompson robinson walker wright mitchell campbell parker edwards collins "
    "stewart morris murphy cooper richardson howard peterson jenkins sanders russell griffin hayes fischer schneider weber "
    "wagner becker hoffmann martin bernard dubois moreau laurent garcia fernandez lopez sanchez romero navarro").split())
SECTIONS = ("/en/12", "/fr/340.html", "/de/77/", "/es/905#top", "/en/613?page=2", "/", "/about", "/articles/2020/05")
ENDINGS = ("example.org", "example.net", "example.com", "test.org", "site.net", "web.com")
BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
STEPS = 300
RATE = 2.0
RIDGE = 1e-3


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, unwanted) rows; every word with a few prefixes, endings and sections in turn."""
    rows = []
    for label, names in ((1, UNWANTED), (0, WANTED)):
        for i, name in enumerate(names):
            for j, prefix in enumerate(("", "www.", "m.", "blog.")):
                rows.append((f"{prefix}{name}.{ENDINGS[(i + j) % 6]}", SECTIONS[(3 * i + j) % len(SECTIONS)], label))
    return rows


def split(url: str | None) -> tuple[str, str]:
    """Lower-cased host (ASCII only) and path."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return host.encode().lower().decode(), tail[:stop]


def grams(parts: Sequence[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram; host and path carry marks at both ends and hash apart."""
    texts = [f"\x01{host}\x02\x03{path}\x04".encode() for host, path in parts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), sizes)
    side = np.cumsum(data == 3) - row  # 0 in the host, 1 in the path
    rows, buckets = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        value = np.zeros(len(data) - n + 1, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + data[j:len(data) - n + 1 + j]
        whole = (row[:len(value)] == row[n - 1:]) & (side[:len(value)] == side[n - 1:])
        value = (value + side[:len(value)].astype(np.uint64) * np.uint64(977) + np.uint64(n))
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        rows.append(row[:len(value)][whole])
        buckets.append((value >> np.uint64(50)).astype(np.int64)[whole])
    return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(buckets or [np.zeros(0, np.int64)])


class Model:
    """Logistic regression over the hashed n-grams, each row scaled to length one."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @staticmethod
    def _values(rows: np.ndarray, n: int) -> np.ndarray:
        return 1.0 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1.0))

    def chance(self, parts: Sequence[tuple[str, str]]) -> np.ndarray:
        """Chance of being unwanted, per (host, path)."""
        rows, buckets = grams(parts)
        scale = self._values(rows, len(parts))
        score = np.bincount(rows, self.weights[buckets], len(parts)) * scale + self.bias
        return 1.0 / (1.0 + np.exp(-score))

    @classmethod
    def train(cls, labelled: Sequence[tuple[str, str, int]]) -> Model:
        """Full-batch gradient descent; the table is small and given by the caller."""
        rows, buckets = grams([r[:2] for r in labelled])
        y = np.array([r[2] for r in labelled], float)
        scale = cls._values(rows, len(y))
        model = cls(np.zeros(BUCKETS), 0.0)
        value = scale[rows]
        for _ in range(STEPS):
            score = np.bincount(rows, model.weights[buckets] * value, len(y)) + model.bias
            error = (1.0 / (1.0 + np.exp(-score)) - y) / len(y)
            slope = np.bincount(buckets, error[rows] * value, BUCKETS) + RIDGE / 10 * model.weights
            model.weights -= RATE * 10 * slope
            model.bias -= RATE * error.sum()
        return model


@lru_cache(maxsize=1)
def default_model() -> Model:
    return Model.train(labelled_urls())


class Rules:
    """Longest fitting rule of a host and path; a rule fits its host, all subdomains and paths that begin with its own."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        for found in self.by_host.values():
            found.sort(key=lambda r: -len(r[0]))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        labels = host.split(".")
        for i in range(len(labels)):
            suffix = ".".join(labels[i:])
            for start, verdict in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(suffix) + len(start) > len(best[0])):
                    best = (suffix + start, verdict)
                    break
        return best


def judge(
    urls: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: Sequence[tuple[str, str, int]] | None = None, block_above: float = 0.5,
) -> DataFrame:
    """(key, host, path, rule, chance, verdict) per row; ``rules`` and ``labelled`` are small tables of the caller."""
    model = Model.train(labelled) if labelled is not None else default_model()
    book = Rules(rules)

    def run(keys, texts):
        parts = [split(t) for t in texts]
        found = [book.find(*p) for p in parts]
        chance = model.chance(parts) if parts else np.zeros(0)
        return {
            key: keys, "host": [p[0] for p in parts], "path": [p[1] for p in parts],
            "rule": [f[0] if f else None for f in found], "chance": chance,
            "verdict": [
                f[1] if f else "block" if p[0] and c > block_above else "allow"
                for f, p, c in zip(found, parts, chance)],
        }

    schema = {key: dict(urls.dtypes)[key].replace("bigint", "long"), "host": "string", "path": "string", "rule": "string",
              "chance": "double", "verdict": "string"}
    return arrow_map(urls.select(key, url), run, schema, rows=4096)


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
