"""Regions, clades and annotation policies: data, with their look-ups."""

import re
from typing import NamedTuple


class Box(NamedTuple):
    west: float
    south: float
    east: float
    north: float

    def scaled(self, by: float) -> "Box":
        """Borders times `by`, cut towards zero to whole numbers (for positions kept as integers)."""
        return Box(*[int(v * by) for v in self])

    def normalised(self) -> "Box":
        """Longitudes beyond 180 moved back by whole turns."""
        turn = lambda x: (x + 180) % 360 - 180
        return Box(turn(self.west), self.south, turn(self.east), self.north)


_BOXES = """
AFRfull w 339.082031 e 421.699219 s -37.718590 n 39.232253
ASIAcentral w 408.515625 e 467.753906 s 36.031332 n 76.142958
ASIAeast w 462.304688 e 550.195313 s 23.241346 n 78.630006
ASIA_nw w 393.046875 e 473.203125 s 46.800059 n 81.621352
ASIAse w 82.441406 e 153.457031 s -11.523088 n 28.613459
ASIAsouth w 420.468750 e 455.097656 s 1.581830 n 39.232253
ASIAsw w 386.718750 e 423.281250 s 12.897489 n 48.922499
AUSfull w 111.269531 e 181.230469 s -47.989922 n -9.622414
EUReast w 10.722656 e 39.550781 s 41.771312 n 59.977005
EURfull w -30.761719 e 43.593750 s 33.284620 n 72.262310
EURnorth w -25.927734 e 45.966797 s 54.673831 n 71.357067
EURwest w -12.128906 e 12.480469 s 40.245992 n 60.586967
MED w -16.259766 e 36.474609 s 29.916852 n 46.316584
NAfull w -169.453125 e -23.554688 s 12.211180 n 84.897147
SAfull w 271.230469 e 330.644531 s -57.040730 n 15.114553
"""
REGIONS = {f[0]: Box(float(f[2]), float(f[6]), float(f[4]), float(f[8])) for f in (line.split() for line in _BOXES.split("\n") if line)}


def region(tag: str) -> Box:
    if tag not in REGIONS:
        raise KeyError(f"unknown region {tag!r}; known: {', '.join(sorted(REGIONS))}")
    return REGIONS[tag]


def _roots(level, *ids: int) -> str:
    name = "taxonID" if level is None else f"L{level}_taxonID"
    return " OR ".join(f'"{name}" = {i}' for i in ids)


#: By kind, in the order of precedence.
CLADES = {
    "meta": {"pta": _roots(50, 47158, 47119)},
    "clade": {
        **{n: _roots(50, i) for n, i in {"actinopterygii": 47178, "amphibia": 20978, "arachnida": 47119, "aves": 3, "insecta": 47158, "liliopsida": 47163, "magnoliopsida": 47124, "mammalia": 40151, "reptilia": 26036}.items()},
        **{n: _roots(40, i) for n, i in {"coleoptera": 47208, "crocodylia": 26039, "diptera": 47822, "hemiptera": 47744, "hymenoptera": 47201, "lepidoptera": 47157, "odonata": 47792, "orthoptera": 47651, "testudines": 39532}.items()},
        **{n: _roots(None, i) for n, i in {"aculeata": 326777, "apoidea": 47222, "formicidae": 47336, "vespidae": 52747, "vespoidea": 48740}.items()},
        "angiospermae": _roots(57, 47125),
        "pterygota": _roots(None, 184884, 418641) + " OR " + _roots(40, 48796),
    },
    "macro": {"arthropoda": _roots(60, 47120), "chordata": _roots(60, 2), "fungi": _roots(70, 47170), "plantae": _roots(70, 47126)},
}


def clade_condition(meta: str | None = None, clade: str | None = None, macro: str | None = None, strict_reference: bool = False) -> str:
    """The first of the names given counts. An unknown name is an error, or TRUE in strict mode."""
    for kind, name in (("meta", meta), ("clade", clade), ("macro", macro)):
        if name:
            if name in CLADES[kind]:
                return CLADES[kind][name]
            if not strict_reference:
                raise KeyError(f"unknown {kind} {name!r}")
            return "TRUE"
    if strict_reference:
        return "TRUE"
    raise KeyError("no clade is named")


def roots(condition: str, strict_reference: bool = False) -> list[tuple[float | None, int]]:
    """(rank level or None for the taxon itself, taxon id) of a clade condition. Strict mode knows whole levels only."""
    pattern = r'"?L([0-9]+)_taxonID"?\s*=\s*([0-9]+)' if strict_reference else r'"?(?:L([0-9]+(?:_5)?)_)?taxonID"?\s*=\s*([0-9]+)'
    return [(float(level.replace("_", ".")) if level else None, int(i)) for level, i in re.findall(pattern, condition)]


def major_floor(level: float) -> float:
    """The major rank below: 57 -> 50, 50 -> 40."""
    floor = level // 10 * 10
    return floor - 10 if floor == level else floor


def boundary(level: float, minor_ranks: bool) -> float:
    return level if minor_ranks else major_floor(level)


#: Annotation policies: name, version, strategy, least trust rank, source kinds, conflicts allowed.
POLICIES = [
    ("human_first", 1, "human_first", 1, ["human", "model", "imported_dataset"], False),
    ("model_first", 1, "model_first", 2, ["human", "model", "imported_dataset"], False),
    ("hybrid", 1, "hybrid", 1, ["human", "model", "imported_dataset"], False),
]
