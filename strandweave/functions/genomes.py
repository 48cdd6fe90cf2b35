"""Compositions of whole assemblies, for samples on one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Folded 3-mers of whole assemblies.
PRESETS = {
    "GRCh38": {
        "ACA": 126_854_213, "ACC": 72_578_891, "ACG": 16_496_260, "ACT": 100_990_627,
        "ATA": 127_495_608, "ATC": 83_838_683, "ATG": 114_451_342, "ATT": 154_599_055,
        "CCA": 115_686_979, "CCC": 82_550_742, "CCG": 17_853_807, "CCT": 111_388_272,
        "CTA": 80_291_697, "CTC": 106_500_910, "CTG": 127_712_228, "CTT": 125_210_558,
        "GCA": 90_643_198, "GCC": 74_544_879, "GCG": 15_448_975, "GCT": 87_637_692,
        "GTA": 70_255_358, "GTC": 59_266_286, "GTG": 95_195_215, "GTT": 92_203_097,
        "TCA": 123_229_713, "TCC": 97_805_448, "TCG": 14_374_345, "TCT": 139_698_895,
        "TTA": 127_454_269, "TTC": 125_503_042, "TTG": 119_055_336, "TTT": 239_999_697,
    },
    "GRCm39": {
        "ACA": 121_650_020, "ACC": 62_814_809, "ACG": 12_036_495, "ACT": 86_300_621,
        "ATA": 105_283_164, "ATC": 72_060_841, "ATG": 99_727_719, "ATT": 114_608_299,
        "CCA": 97_759_775, "CCC": 71_314_595, "CCG": 11_690_957, "CCT": 96_531_716,
        "CTA": 72_258_737, "CTC": 94_079_833, "CTG": 110_434_398, "CTT": 112_816_987,
        "GCA": 74_126_008, "GCC": 56_103_704, "GCG": 9_410_763, "GCT": 76_061_814,
        "GTA": 61_141_141, "GTC": 55_774_985, "GTG": 85_619_453, "GTT": 80_266_372,
        "TCA": 101_795_998, "TCC": 87_063_932, "TCG": 10_707_178, "TCT": 130_695_796,
        "TTA": 99_793_970, "TTC": 108_347_453, "TTG": 99_550_228, "TTT": 176_793_317,
    },
}


def preset(spark: SparkSession, assembly: str) -> DataFrame:
    """tri, n of an assembly's 32 contexts."""
    if assembly not in PRESETS:
        raise ValueError(f"unknown assembly {assembly}; known: {', '.join(PRESETS)}")
    return spark.createDataFrame(list(PRESETS[assembly].items()), "tri string, n long")
