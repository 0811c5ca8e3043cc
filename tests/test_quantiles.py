import numpy as np

from tessera.operators import profile as P


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.lognormal(2.0, 0.5, 3000), np.full(500, 7.25), [1e9, -3.5, 0.0]])
    rows = [(float(v),) for v in vals] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    qs = (0.0, 0.01, 0.33, 0.5, 0.67, 0.999, 1.0)
    # few buckets force many narrowing rounds (outlier at 1e9)
    got = P.exact_quantiles(df, "x", qs, buckets=8)
    want = np.percentile(vals, [q * 100 for q in qs], method="linear")
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_exact_quantiles_empty_and_constant(spark):
    assert P.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", (0.5,)) == [None]
    c = spark.createDataFrame([(3.0,)] * 50, "x double")
    assert P.exact_quantiles(c, "x", (0.1, 0.9), buckets=4) == [3.0, 3.0]


def test_infinities_and_neighbouring_doubles(spark):
    import math

    import numpy as np
    from tessera.operators.profile import exact_quantiles
    inf = math.inf
    df = spark.createDataFrame([(x,) for x in (-inf, 1.0, 2.0, 4.0, inf, inf)], "x double")
    assert exact_quantiles(df, "x", [0.0, 0.2, 0.5, 0.8, 1.0]) == [-inf, 1.0, 3.0, inf, inf]
    near = [1.0, float(np.nextafter(1.0, 2.0)), float(np.nextafter(np.nextafter(1.0, 2.0), 2.0))]
    assert exact_quantiles(spark.createDataFrame([(x,) for x in near], "x double"), "x", [0.5]) == [near[1]]
    wide = [-1.7e308, 0.0, 1.7e308]
    assert exact_quantiles(spark.createDataFrame([(x,) for x in wide], "x double"), "x", [0.5]) == [0.0]
