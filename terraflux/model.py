"""Constants of the data model: quality flags, units, site names, standard names.

Fixed values: the tables below state public definitions (tower-data quality flags, unit factors, site codes) and are
given as they are, in natural order.
"""

from __future__ import annotations

#: The quality flags of tower data, whether they pass, and the public definition's own words. A flag that is not
#: listed is unknown and passes.
QC_FLAGS = {
    # levels 1 to 3
    0: (True, "Data has passed all QC checks"),
    1: (False, "Data missing from L1 Excel spreadsheet"),
    2: (False, "Failed range check"),
    3: (False, "Failed CSAT check, Diag_CSAT flag!=0 (do_CSATcheck)"),
    4: (False, "Failed 7500 check, Diag_7500 flag!=0 plus dependencies on AGC_7500, Ah_7500_Sd, Cc_7500_Sd, AhAh, CcCc (do_7500check)"),
    5: (False, "Failed diurnal check"),
    6: (False, "Date/time range excluded"),
    7: (False, "Hour range excluded"),
    8: (False, "Value of -9999 found with QC flag value of 0"),
    9: (False, "Fre set to missing when (Fsd>threshold) or (ustar<threshold)"),
    10: (True, "Linear correction or linear drift correction applied to data"),
    11: (False, "Dependent data rejected during 2D coordinate rotation"),
    12: (False, "Data rejected due to dependencies when calculating Massman frequency corrections (MassmanStandard)"),
    13: (False, "Fh rejected during conversion of Fhv to Fh (FhvtoFh)"),
    14: (False, "Fc rejected during WPL correction due to dependencies (Fc_WPLcov/Fe_WPL/Fe_WPLcov)"),
    15: (True, "Ta calculated from CSAT Tv rejected due to dependencies (TaFromTv)"),
    16: (False, "Data rejected at L3 due to failed range check (do_qcchecks)"),
    17: (False, "Data rejected at L3 due to failed diurnal check (do_qcchecks)"),
    18: (False, "Ustar below threshold (FilterUstar)"),
    19: (False, "Data rejected during coordination of gaps in flux series"),
    20: (True, "GapFilling: Driver gap filled using alternate data CONFLICT: same code used by ReplaceRotatedCovariance"),
    21: (True, "Missing rotated covariance replaced with non-rotated value CONFLICT: same code used in gfalternate_main"),
    22: (True, "Soil moisture set to default value in CorrectFgForStorage"),
    30: (True, "GapFilling: Flux Gap Filled by ANN (SOLO)"),
    31: (True, "GapFilling: Flux Gap not Filled by ANN"),
    35: (False, "Data replaced by alternate value when difference between data and alternate value exceeds threshold (ReplaceWhenDiffExceedsRange)"),
    38: (False, "Data rejected at L4 due to failed range check (do_qcchecks)"),
    39: (False, "Data rejected at L4 due to failed diurnal check (do_qcchecks)"),
    40: (False, "Gap filled from climatology"),
    41: (False, "No value available from GapFillUsingClimatology"),
    50: (False, "Gap filled by interpolation"),
    51: (False, "Fsd below threshold when calculating albedo"),
    52: (False, "Hour outside range 1000 to 1400 when calculating albedo"),
    60: (False, "Flux data generated by GapFillFluxFromDayRatio"),
    61: (False, "Stomatal resistance less than 0 (get_stomatalresistance)"),
    62: (False, "Fe less than threshold when calculating stomatal resistance (get_stomatalresistance)"),
    63: (False, "Fsd less than threshold when calculating stomatal resistance (get_stomatalresistance)"),
    64: (False, "Wind speed = 0 when calculating stomatal resistance (get_stomatalresistance)"),
    70: (False, "Partitioning Night: Re computed from exponential temperature response curves"),
    80: (False, "Partitioning Day: GPP/Re computed from light-response curves, GPP = Re - Fc"),
    81: (False, "Partitioning Day: GPP night mask"),
    82: (False, "Partitioning Day: Fc > Re, GPP = 0, Re = Fc"),
    # level 4
    400: (False, "Reserved"),
    410: (False, "Gap filled using automatic weather station (AWS) data."),
    420: (False, "Gap filled using ACCESS-G numerical weather prediction (NWP) data."),
    430: (False, "Gap filled using ECMWF Re-Analysis Interim (ERAI) data."),
    440: (False, "Gap filled using ECMWF Re-Analysis 5 (ERA5) data."),
    450: (False, "Gap filled using climatology, interpolated daily (default)"),
    460: (False, "Gap filled using climatology, monthly (not implemented)"),
    470: (False, "Gap filled using Marginal Distribution Sampling (MDS)"),
    # level 5
    500: (False, "Reserved"),
    501: (False, "Reserved"),
    502: (False, "Fco2 masked by turbulence filter (flag only used in intermediate variable Fco2_filtered)"),
    510: (False, "Flux gap filled using SOLO neural network (windowed)"),
    520: (False, "Flux gap filled using SOLO neural network (long gaps)"),
    570: (False, "Flux gap filled using Marginal Distribution Sampling (MDS)"),
    # level 6
    600: (False, "Reserved"),
    601: (False, "ER observation masked because Fco2 flag not in [0, 10]"),
    602: (False, "ER observation masked because it is day time"),
    610: (False, "ER estimated by SOLO neural network from nocturnal, u*-filtered NEE"),
    620: (False, "ER estimated using Lloyd & Taylor (1994) from nocturnal, u*-filtered NEE"),
    630: (False, "ER estimated using Lasslop et al (2010) from nocturnal, u*-filtered NEE (E0) and both daytime and nighttime NEE (alpha, beta0, VPD0, k, rb)"),
}
FAILING_FLAGS = frozenset(flag for flag, (passed, _) in QC_FLAGS.items() if not passed)

KELVIN = 273.15
SECONDS_PER_DAY = 86_400
CARBON_G_PER_MOL = 12.011

#: Unit names that mean the same.
UNIT_SYNONYMS = (
    ("W/m2", "W/m^2", "Wm^-2", "W m-2"),
    ("kg/m2/s", "kg/m^2/s", "kgm^-2s^-1", "kg m-2 s-1"),
    ("kg/m2/day", "kg/m^2/day", "mm/day"),
    ("mm", "kg/m2", "kg m-2"),
    ("K", "k"),
    ("m/s", "ms^-1"),
    ("Pa", "pa"),
    ("kg/kg", "kg kg-1", "", "mm/mm", "m/m", "1"),
    ("ppm", "umol/mol"),
    ("degC", "°C", "degrees C"),
    ("umol/m2/s", "umol/m^2/s"),
    ("m3/m3", "m^3/m^3", "m3 m-3"),
    ("gC/m^2/day", "gC/m2/day"),
)

#: Conversions as (factor, power of the step in seconds, offset): value * factor * step ** power + offset.
UNIT_CONVERSIONS = {
    ("g", "kg"): (1e-3, 0, 0.0),
    ("mm", "kg/m2/s"): (1.0, -1, 0.0),
    ("kg/m2/s", "mm"): (1.0, 1, 0.0),
    ("kg/m2/s", "mm/day"): (86400.0, 0, 0.0),
    ("mm/day", "mm"): (1 / 86400, 1, 0.0),
    ("gC/m^2/day", "kgC/m2"): (1e-3 / 86400, 1, 0.0),
    ("degC", "K"): (1.0, 0, KELVIN),
    ("K", "degC"): (1.0, 0, -KELVIN),
    ("kPa", "Pa"): (1e3, 0, 0.0),
    ("Pa", "kPa"): (1e-3, 0, 0.0),
    ("hPa", "Pa"): (100.0, 0, 0.0),
    ("hPa", "kPa"): (0.1, 0, 0.0),
    ("umol/m2/s", "kgC/m2/day"): (1e-6 * CARBON_G_PER_MOL * 1e-3 * SECONDS_PER_DAY, 0, 0.0),
    ("umol/m2/s", "gC/m2/day"): (1e-6 * CARBON_G_PER_MOL * SECONDS_PER_DAY, 0, 0.0),
    ("umol/m2/s", "gC/m2"): (1e-6 * CARBON_G_PER_MOL, 1, 0.0),
    ("umol/m2/s", "kgC/m2"): (1e-6 * CARBON_G_PER_MOL * 1e-3, 1, 0.0),
    ("Mg/ha", "kg/m2"): (0.1, 0, 0.0),
    ("/ha", "/m2"): (1e-4, 0, 0.0),
    ("percent", "1"): (0.01, 0, 0.0),
}

#: Metres in a unit of length.
LENGTHS = {"m": 1.0, "km": 1000.0, "au": 1.495979e11, "cm": 0.01, "mm": 0.001}

SITE_CODES = {
    "AU-Ade": "AdelaideRiver", "AU-APL": "AlpinePeatland", "AU-ASM": "AliceSpringsMulga", "AU-Boy": "Boyagin", "AU-Cm1": "ColeamballyMaizeWheat",
    "AU-Cm2": "ColeamballyRice", "AU-Col": "Collie", "AU-Cow": "CowBay", "AU-Cpr": "Calperum", "AU-Ctr": "CapeTribulation", "AU-Cum": "CumberlandPlain",
    "Au-CuP": "CumberlandPlain", "AU-DaS": "DalyUncleared", "AU-DaP": "DalyPasture", "AU-Drg": "Dargo", "AU-Dry": "DryRiver", "Au-Fle": "FletcherView",
    "AU-Fog": "FoggDam", "AU-Gin": "Gingin", "AU-GWW": "GreatWesternWoodlands", "AU-How": "HowardSprings", "AU-Lit": "Litchfield", "AU-Nim": "Nimmo",
    "NZ-Oxf": "Oxford", "AU-Otw": "Otway", "AU-Rgf": "Ridgefield", "AU-Rig": "RiggsCreek", "AU-Rob": "RobsonCreek", "AU-Sam": "Samford",
    "AU-Sil": "SilverPlains", "AU-Stp": "SturtPlains", "AU-TTE": "TiTreeEast", "AU-Tum": "Tumbarumba", "AU-Vir": "VirginiaPark", "AU-Wac": "WallabyCreek",
    "AU-Whr": "Whroo", "AU-Wom": "WombatStateForest", "AU-Wrr": "Warra", "AU-Ync": "Yanco", "AU-Yar": "Yarramundi",
}
SITES_WITHOUT_CODES = ("Arcturus", "Emerald", "Longreach", "Loxton", "RedDirtMelonFarm")
SITE_SYNONYMS = {
    "FletcherviewTropicalRangeland": "FletcherView",
    "AliceSpringsMulga1": "AliceSpringsMulga",
    "AliceSpringsMulga2": "AliceSpringsMulga",
    "Wallaby": "WallabyCreek",
    "YarramundiControl": "YarCon",
    "YarramundiIrrigated": "YarIrr",
}
#: Sites that two sources may both describe.
DUPLICATE_SITES_ALLOWED = ("AliceSpringsMulga",)

PRECIP_AMOUNT_UNITS = ("mm", "kg m-2")
PRECIP_RATE_UNITS = ("mm/s", "mm s-1", "kg m-2 s-1", "mm/d", "mm d-1", "mm/day", "mm day-1", "kg m-2 d-1", "kg m-2 day-1")
#: Standard names of variable kinds other than precipitation ("pr").
STANDARD_NAMES = {
    "temp": "air_temperature", "swr": "surface_downwelling_shortwave_flux_in_air", "co2": "mole_fraction_of_carbon_dioxide_in_air",
    "vpd": "water_vapor_saturation_deficit_in_air", "ps": "air_pressure", "tmax": "air_temperature_maximum", "tmin": "air_temperature_minimum",
    "rh": "relative_humidity", "sh": "specific_humidity", "nhx": "ndep_nhx", "noy": "ndep_noy", "ws": "wind_speed",
    "lat": "latitude", "lon": "longitude", "time": "time",
}
PRECIP_AMOUNT, PRECIP_RATE = "precipitation_amount", "precipitation_flux"

#: Saturation vapour pressure a * exp(b * t / (c + t)): a in Pa, c and t in degrees Celsius.
MAGNUS = {"sonntag": (611.2, 17.62, 243.12), "alduchov": (610.94, 17.625, 243.04), "allen": (610.8, 17.27, 237.3), "mixed": (611.2, 17.62, 243.04)}
