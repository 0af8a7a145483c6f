"""Published closed forms for microwave backscatter of soil and canopy, as columns.

Powers are linear, lengths in metres, angles in degrees, frequency in GHz.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants and the coefficients of the cited models.
LIGHT_SPEED_M_PER_S = 299792458.0
SOLID_DENSITY = 2.66
DOBSON_ALPHA = 0.65
WATER_HIGH_FREQ = 4.9
WATER_RELAXATION = (1.1109e-10, -3.824e-12, 6.938e-14, -5.096e-16)
WATER_STATIC = (88.045, -0.4147, 6.295e-4, 1.075e-5)
BETA_REAL = (1.2748, -0.519, -0.152)
CANOPY_ALBEDO_FACTOR = 0.75


def _poly(x: Column, coefficients) -> Column:
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def wavenumber(f_ghz: float) -> float:
    """Free-space wavenumber in rad/m."""
    return 2.0 * math.pi * f_ghz * 1e9 / LIGHT_SPEED_M_PER_S


def soil_permittivity(
    sand: Column, clay: Column, bulk: Column, moisture: Column, temperature: Column, f_ghz: float
) -> Column:
    """Real relative permittivity of moist soil (Dobson et al. 1985).

    Texture as fractions, bulk density in g/cm3, temperature in Celsius.
    """
    solid = (1.01 + 0.44 * SOLID_DENSITY) ** 2 - 0.062
    tau = _poly(temperature, WATER_RELAXATION) * F.lit(f_ghz * 1e9)
    static = _poly(temperature, WATER_STATIC)
    water = F.lit(WATER_HIGH_FREQ) + (static - WATER_HIGH_FREQ) / (F.lit(1.0) + tau * tau)
    beta = F.lit(BETA_REAL[0]) + F.lit(BETA_REAL[1]) * sand + F.lit(BETA_REAL[2]) * clay
    mixed = (
        F.lit(1.0)
        + bulk / F.lit(SOLID_DENSITY) * F.lit(solid**DOBSON_ALPHA - 1.0)
        + F.pow(moisture, beta) * F.pow(water, F.lit(DOBSON_ALPHA))
        - moisture
    )
    return F.when(mixed > 0, F.pow(mixed, F.lit(1.0 / DOBSON_ALPHA)))


class ArrayMath:
    """The functions of ``power`` for arrays."""

    exp, pow = np.exp, np.power


class SurfaceModel(NamedTuple):
    """A vv backscatter model in two parts, so that a grid over (s, length) repeats little.

    ``terms`` are columns free of roughness; ``power(s, length, terms, m)``
    combines them with s and the correlation length, ``m`` giving ``exp`` and
    ``pow``: Spark's functions for columns, :class:`ArrayMath` for arrays.
    """

    terms: Callable[[Column, Column, float], dict[str, Column]]
    power: Callable


def _spm_terms(eps: Column, theta_deg: Column, f_ghz: float) -> dict[str, Column]:
    k = wavenumber(f_ghz)
    cos, sin = F.cos(F.radians(theta_deg)), F.sin(F.radians(theta_deg))
    root = F.sqrt(eps - sin * sin)
    alpha = (eps - 1.0) * (sin * sin - eps * (F.lit(1.0) + sin * sin)) / F.pow(eps * cos + root, F.lit(2.0))
    return {
        "gain": F.lit(8.0 * k**4) * F.pow(cos, F.lit(4.0)) * alpha * alpha,
        "twice_k_sin": F.lit(2.0 * k) * sin,
    }


def _spm_power(s, length, at, m=F):
    q = at["twice_k_sin"] * length
    return at["gain"] * s * s * length * length / m.pow(q * q + 1.0, 1.5)


def _oh_terms(eps: Column, theta_deg: Column, f_ghz: float) -> dict[str, Column]:
    theta = F.radians(theta_deg)
    cos, sin, n = F.cos(theta), F.sin(theta), F.sqrt(eps)
    root = F.sqrt(eps - sin * sin)
    normal = F.pow((F.lit(1.0) - n) / (F.lit(1.0) + n), F.lit(2.0))
    horizontal = F.pow((cos - root) / (cos + root), F.lit(2.0))
    vertical = F.pow((eps * cos - root) / (eps * cos + root), F.lit(2.0))
    return {
        "k": F.lit(wavenumber(f_ghz)),
        "shape": F.lit(0.7) * F.pow(cos, F.lit(3.0)) * (vertical + horizontal),
        "slope": F.pow(theta * (2.0 / math.pi), F.lit(1.0) / (F.lit(3.0) * normal)),
    }


def _oh_power(s, length, at, m=F):
    ks = at["k"] * s
    return at["shape"] * (1.0 - m.exp(m.pow(ks, 1.8) * -0.65)) / (1.0 - at["slope"] * m.exp(-ks))


def _dubois_terms(eps: Column, theta_deg: Column, f_ghz: float) -> dict[str, Column]:
    theta = F.radians(theta_deg)
    cos, sin, tan = F.cos(theta), F.sin(theta), F.tan(theta)
    wavelength_cm = 100.0 * LIGHT_SPEED_M_PER_S / (f_ghz * 1e9)
    return {
        "shape": F.lit(10.0**-2.35 * wavelength_cm**0.7)
        * F.pow(cos, F.lit(3.0))
        / F.pow(sin, F.lit(3.0))
        * F.pow(F.lit(10.0), F.lit(0.046) * eps * tan),
        "k_sin3": F.lit(wavenumber(f_ghz)) * sin * sin * sin,
    }


def _dubois_power(s, length, at, m=F):
    return at["shape"] * m.pow(at["k_sin3"] * s, 1.1)


#: first-order small perturbation with an exponential correlation function (Ulaby et al. 1986),
#: and the empirical models of Oh et al. 1992 and Dubois et al. 1995, which do not use the length
SURFACE_MODELS = {
    "SPM": SurfaceModel(_spm_terms, _spm_power),
    "OH1992": SurfaceModel(_oh_terms, _oh_power),
    "DUBOIS1995": SurfaceModel(_dubois_terms, _dubois_power),
}


def soil_backscatter(
    model: str, s: Column, length: Column, eps: Column, theta_deg: Column, f_ghz: float
) -> Column:
    """vv backscatter power of bare soil."""
    surface = SURFACE_MODELS[model]
    return surface.power(s, length, surface.terms(eps, theta_deg, f_ghz))


def canopy_path(rvi: Column, depth: Column, theta_deg: Column) -> Column:
    """Two-way path of extinction through a canopy, per unit of c (extinction is c * sqrt(rvi))."""
    return F.lit(-2.0) * F.sqrt(rvi) * depth / F.cos(F.radians(theta_deg))


def canopy_gain(theta_deg: Column) -> Column:
    """Single-scattering gain of the canopy (water-cloud form): its return is w * gain * (1 - T)."""
    return F.lit(CANOPY_ALBEDO_FACTOR) * F.cos(F.radians(theta_deg))
