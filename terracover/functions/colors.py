"""Colour arithmetic of the legends (E24, M6); a handful of constants, so it runs on the driver."""

from __future__ import annotations

from .tables import PALETTE

Rgb = tuple[int, int, int]


def parse(colour: str) -> Rgb:
    value = int(colour.lstrip("#"), 16)
    return value >> 16, value >> 8 & 255, value & 255


def text(rgb: Rgb) -> str:
    return "#" + "".join(f"{c:02x}" for c in rgb)


def blend(a: Rgb, b: Rgb, share: float) -> Rgb:
    """share of b in a, each channel rounded half to even."""
    return tuple(round(x + (y - x) * share) for x, y in zip(a, b, strict=True))


def ramp(colour: str, steps: int = 6) -> list[str]:
    """From a light tint (88 % white) to a dark shade (35 % black) of one colour."""
    light, dark = blend(parse(colour), (255, 255, 255), 0.88), blend(parse(colour), (0, 0, 0), 0.35)
    return [text(blend(light, dark, k / (steps - 1) if steps > 1 else 0.0)) for k in range(steps)]


def darken(colour: str, share: float = 0.45) -> str:
    return text(blend(parse(colour), (0, 0, 0), share))


def brand_colour(brand: str, category: str, brands: dict[str, str], fallback: dict[str, str]) -> str:
    return brands.get(brand, fallback[category])


def sample(colours: list[str], n: int) -> list[str]:
    """n colours spread over a palette; of one, the darkest."""
    if n <= 1:
        return [colours[-1]]
    return [colours[int(k * (len(colours) - 1) / (n - 1) + 0.5)] for k in range(n)]


def palette_for(selected: list[str], brands: dict[str, str]) -> list[str]:
    """A single selected brand with a colour of its own gives its ramp, else the default palette."""
    return ramp(brands[selected[0]]) if len(selected) == 1 and selected[0] in brands else PALETTE
