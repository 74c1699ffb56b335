"""Laboratory component codes per test type.

Fixed values.  Within one registry the sets do not overlap, so a code has at most one type.
"""

HEPATITIS_CODES: dict[str, tuple[int, ...]] = {
    "AB": (1526626, 1230000019),
    "RNA": (784, 1811181, 4338, 30400316, 1230001110, 1230001112, 1230001113, 2236, 2337),
    "Genotype": (2618, 3061, 1230001115, 1811182),
}

HIV_CODES: dict[str, tuple[int, ...]] = {
    "AB": (273, 275, 587, 1348, 1496, 2412, 1740042, 30409193, 1230001172, 1234444644),
    "Differentiation": (
        1257, 2005, 2221, 2222, 1612903, 1740031, 1230001157, 1230001159, 1234444746, 1234444747,
    ),
    "Confirmatory": (268, 1558004),
    "RNA": (
        1497, 1662, 2268, 2269, 1510740, 1561915,
        1230001158, 1230001163, 1230002269, 1234101169, 1234444899,
    ),
    "CD4 Absolute": (1558135, 1230000596),
    "CD4 Percentage": (1558134, 1230000594),
}

# Differentiation components whose long comments are read line by line.
COMMENTED_COMPONENTS: tuple[int, ...] = (2221, 2222)
