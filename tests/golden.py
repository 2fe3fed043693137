"""Published results for the electricity readings of two countries, 2021 to 2024.

Fixed values.  The readings themselves are not available.
"""

YEARLY_ITALY = """\
2021,280.084245,46.305932
2022,321.617976,41.244127
2023,251.819465,51.596057
2024,207.299189,57.431828"""

MONTHLY = """\
2021-01,291.184718,43.539341
2021-02,270.851324,48.668185
2021-03,268.785121,47.385847
2021-04,281.897986,45.059931
2021-05,217.948212,58.262554
2021-06,245.779056,53.068403
2021-07,255.257581,50.298952
2021-08,248.662487,52.676573
2021-09,308.954125,41.640458
2021-10,296.797796,43.954745
2021-11,346.728514,33.076681
2021-12,329.303508,37.868817
2022-01,326.947876,36.603683
2022-02,330.489896,38.980595
2022-03,347.359073,35.822218
2022-04,286.829444,46.882681
2022-05,278.905793,49.765565
2022-06,302.611042,44.933722
2022-07,320.503602,42.209194
2022-08,320.927339,40.839435
2022-09,328.940597,41.090514
2022-10,335.784745,39.167164
2022-11,318.867014,42.927639
2022-12,360.52,35.83832
2023-01,325.063548,43.14629
2023-02,326.363958,41.723616
2023-03,300.272755,46.187594
2023-04,219.668708,54.275889
2023-05,203.494489,59.877003
2023-06,238.369903,55.660375
2023-07,248.732043,50.746962
2023-08,230.276129,54.55711
2023-09,250.623222,50.493986
2023-10,234.661263,52.50797
2023-11,210.026097,58.736986
2023-12,238.637702,50.69586
2024-01,232.030632,52.224194
2024-02,225.667399,54.523319
2024-03,192.853871,60.919556
2024-04,170.670889,66.253958
2024-05,158.240887,68.989731
2024-06,171.978792,65.487792
2024-07,200.595995,57.939099
2024-08,224.420538,52.27996
2024-09,218.139361,54.222792
2024-10,206.335591,58.53039
2024-11,249.970847,48.306319
2024-12,237.27578,49.46375"""

# Months of each ranking in order.
TOP = {
    "carbon_desc": ["2022-12", "2022-03", "2021-11", "2022-10", "2022-02"],
    "carbon_asc": ["2024-05", "2024-04", "2024-06", "2024-03", "2024-07"],
    "cfe_desc": ["2024-05", "2024-04", "2024-06", "2024-03", "2023-05"],
    "cfe_asc": ["2021-11", "2022-03", "2022-12", "2022-01", "2021-12"],
}

HOURLY = """\
0,IT,280.357796,47.465517
1,IT,279.445702,47.734702
2,IT,278.96013,47.795873
3,IT,281.543936,47.011533
4,IT,284.950883,45.621506
5,IT,280.379836,46.20783
6,IT,265.65345,49.351691
7,IT,248.486338,52.606626
8,IT,235.093799,54.776845
9,IT,226.012122,56.260664
10,IT,220.763217,57.130055
11,IT,219.029329,57.423648
12,IT,221.68629,56.845366
13,IT,229.271095,55.235065
14,IT,243.049158,52.378159
15,IT,260.61269,48.916509
16,IT,276.171034,46.447228
17,IT,285.181369,45.764079
18,IT,289.712204,45.028125
19,IT,293.715421,43.436886
20,IT,296.746208,42.203176
21,IT,296.306674,42.428426
22,IT,288.799815,44.718823
23,IT,282.04553,46.815469
0,SE,4.284784,99.411923
1,SE,4.407043,99.395127
2,SE,4.561875,99.377488
3,SE,4.302491,99.411588
4,SE,3.912149,99.461951
5,SE,3.858296,99.466838
6,SE,4.34989,99.411068
7,SE,4.769665,99.354969
8,SE,5.195558,99.305209
9,SE,5.489035,99.273518
10,SE,5.736708,99.240253
11,SE,5.94718,99.213936
12,SE,5.922875,99.215441
13,SE,5.366119,99.278741
14,SE,4.756783,99.348939
15,SE,4.15896,99.410281
16,SE,3.908172,99.440281
17,SE,3.589062,99.487515
18,SE,3.357105,99.509055
19,SE,3.245243,99.52191
20,SE,3.166509,99.537454
21,SE,3.150062,99.540979
22,SE,3.438946,99.506619
23,SE,3.824661,99.467488"""

STATS = [
    ("IT", "carbon-intensity", 219.029329, 241.060318, 279.202916, 285.008504, 296.746208),
    ("IT", "cfe", 42.203176, 45.728436, 47.60011, 53.149181, 57.423648),
    ("SE", "carbon-intensity", 3.150062, 3.765761, 4.293638, 4.876138, 5.94718),
    ("SE", "cfe", 99.213936, 99.338007, 99.411328, 99.472495, 99.540979),
]

# Run times in seconds, with their published mean and sample deviation.
RUNS = {
    ("q1", "df"): [48.4, 47.94, 47.5, 48.2, 48.25, 48.21, 47.71, 49.9, 55.09, 83.3],
    ("q1", "rdd"): [35.63, 45.12, 42.19, 47.23, 40.91, 41.96, 43.79, 40.74, 41.67, 41.92],
    ("q1", "sql"): [49.23, 48.02, 49.88, 47.98, 50.17, 49.47, 48.73, 48.66, 49.42, 48.88],
}
RUN_SUMMARY = {("q1", "df"): (52.45, 11.07), ("q1", "rdd"): (42.12, 3.05), ("q1", "sql"): (49.04, 0.73)}


def rows(text: str, *kinds) -> list[tuple]:
    return [
        tuple(kind(field) for kind, field in zip(kinds, line.split(","), strict=True))
        for line in text.splitlines()
    ]
