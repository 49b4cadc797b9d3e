import math
from itertools import combinations

import pytest

from tidemark.functions import pvalues


def test_ks_recorded_value():
    assert pvalues.ks_two_sample(0.06390640454995053, 1348, 1152, "exact") == pytest.approx(0.011816423854, abs=1e-12)


@pytest.mark.parametrize("n_a,n_b", [(3, 4), (4, 4), (2, 6), (6, 2), (1, 5), (5, 7)])
def test_ks_against_enumeration(n_a, n_b):
    total = n_a + n_b
    distances = []
    for chosen in combinations(range(total), n_a):
        a = b = 0
        worst = 0.0
        for i in range(total):
            if i in chosen:
                a += 1
            else:
                b += 1
            worst = max(worst, abs(a / n_a - b / n_b))
        distances.append(worst)
    for d in sorted(set(distances)):
        share = sum(x >= d - 1e-12 for x in distances) / len(distances)
        assert pvalues.ks_two_sample(d, n_a, n_b, "exact") == pytest.approx(share, abs=1e-12)


def test_ks_large_samples_use_the_limit():
    assert pvalues.ks_two_sample(0.06390640454995053, 1348, 1152) == pytest.approx(0.012519, abs=1e-5)
    assert pvalues.ks_two_sample(0.0, 5, 5) == 1.0


def test_ks_exact_on_large_samples():
    # the exact share approaches the limit as the samples grow; the lattice of equal sizes is the coarsest
    for n_a, n_b, near in ((1_000_000, 1_000_000, 0.01), (40_000, 40_001, 0.02), (40_001, 40_000, 0.02)):
        d = 1.36 / math.sqrt(n_a * n_b / (n_a + n_b))
        assert pvalues.ks_two_sample(d, n_a, n_b, "exact") == pytest.approx(pvalues.ks_two_sample(d, n_a, n_b), rel=near)
    assert 0 < pvalues.ks_two_sample(0.3, 4000, 3999, "exact") < 1e-100


def test_chi_square_values():
    assert pvalues.chi_square(5.8076007123260105, 1) == pytest.approx(0.01595705048308733, rel=1e-12)
    assert pvalues.chi_square(5.991464547, 2) == pytest.approx(0.05, rel=1e-8)
    assert pvalues.chi_square(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-12)
    assert pvalues.chi_square(18.307038, 10) == pytest.approx(0.05, rel=1e-6)
    assert pvalues.chi_square(2.0, 10) == pytest.approx(0.99634015, rel=1e-6)
    assert pvalues.chi_square(0.0, 3) == 1.0


def test_f_values():
    # with one numerator degree F is a squared t; t(0.975, 10) = 2.228138852
    assert pvalues.f_ratio(2.228138852**2, 1, 10) == pytest.approx(0.05, rel=1e-7)
    # two numerator degrees have a closed form
    assert pvalues.f_ratio(3.0, 2, 8) == pytest.approx((1 + 2 * 3.0 / 8) ** -4, rel=1e-12)
    assert pvalues.f_ratio(0.01, 1, 50) == pytest.approx(0.9207, abs=1e-4)
    assert math.isnan(pvalues.f_ratio(math.nan, 1, 5))
