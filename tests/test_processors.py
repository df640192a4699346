"""Processor lists out of specification documents, rule by rule."""

import json

from pyspark.sql import functions as F

from tessera.operators import processors

CASES = [
    (None, None),
    ("", None),
    ("{", None),
    ("[]", None),
    ('{"CPU": null}', None),
    ('{"CPU": []}', None),
    (json.dumps({"Superchip": ["- nvidia grace cpu x", "NVIDIA® Hopper™ GPU", "Nvidia Grace CPU"]}), ["NVIDIA Grace CPU", "NVIDIA Hopper GPU"]),
    (json.dumps({"Superchip": {"a": "nvidia grace cpu"}}), None),
    (json.dumps({"CPU": "Intel Xeon W-3500/W-3400"}), ["Intel Xeon W-3500 series processor", "Intel Xeon W-3400 series processor"]),
    (json.dumps({"CPU": ["AMD Ryzen Threadripper PRO 3000WX Series"]}), ["AMD Ryzen Threadripper PRO 3000WX processor"]),
    (json.dumps({"CPU": "AMD ryzen™ threadripper™ pro 5000WX"}), ["Ryzen Threadripper PRO 5000WX"]),
    (json.dumps({"CPU": ["AMD EPYC 4004 Series Processors", "AMD Ryzen 7000 Series Processors", "TDP up to 170W", "[Note] x"]}), ["AMD EPYC 4004 Series processors", "AMD Ryzen 7000 Series processors"]),
    (json.dumps({"CPU": ["AMD EPYC 4004 Series Processors", "AMD Ryzen 7000 Series Processors", "[Note] x"]}), None),
    (json.dumps({"CPU": ["- AMD EPYC 4004 Series Processors", "AMD Ryzen 7000 Series Processor", "", "[Note] x"]}), ["- AMD EPYC 4004 Series processors", "AMD Ryzen 7000 Series Processor"]),
    (json.dumps({"CPU": {"a": "Support for 4th and 5th Generation: Intel® Xeon® Processors / Intel Max Processor in the LGA package"}}), [f"{n} Generation Intel {x} processors" for n in ("4th", "5th") for x in ("Xeon", "Max")]),
    (json.dumps({"CPU": ["4th and 5th Generation", "Intel Xeon Scalable", "Intel Xeon Max processors"]}), [f"{n} Generation Intel Xeon Max processors" for n in ("4th", "5th")]),
    (json.dumps({"CPU": ["AmpereOne®", "Family Processors", "TDP up to 350W"]}), ["AmpereOne  Family processor"]),
    (json.dumps({"CPU": ["Ampere® Altra® Max Processors", "Ampere Altra processor"]}), ["Ampere  Altra  Max  processor", "Ampere  Altra  processor"]),
    (json.dumps({"CPU": ["Ampere", "Altra", "Max or Altra", "7nm technology"]}), ["Ampere  Altra  Max or Ampere Altra  processor"]),
    (json.dumps({"CPU": "[note] x"}), None),
    (json.dumps({"CPU": "amd ryzen™ threadripper™ pro 7000 series processors /\nAMD Ryzen Threadripper 7000 Processors\n\nx\nAMD Ryzen Threadripper 7000 processor"}), ["AMD Ryzen Threadripper PRO 7000 series Processors", "AMD Ryzen Threadripper 7000 Series Processors"]),
    (json.dumps({"CPU": "- Built in with an Intel® Celeron N3350 Cpu (1.1 GHz) (2M cache)\nbuilt in an amd embedded apu 200 board"}), ["Intel Celeron N3350 CPU", "AMD embedded APU 200"]),
    (json.dumps({"CPU": ["AMD Ryzen Threadripper PRO 7000 series processors\nx"]}), None),
]


def test_first_fitting_rule(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", processors.processor_list(F.col("t")).alias("p")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == want, text


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([(json.dumps({"CPU": ["x" * 100_000] * 20 + ["Ampere Altra Processors"]}),)], "t string")
    assert df.select(processors.processor_list(F.col("t"))).collect()[0][0] == ["Ampere  Altra  processor"]
    assert df.limit(0).select(processors.processor_list(F.col("t"))).collect() == []


# One rule at a time: lines of a cell, the rule, its names (None: it does not fit).
RULE_CASES = [
    (processors.several_generations, ["5th Generation Intel", "®", "Xeon", "®", "Scalable Processors", "4th Generation Intel", "®", "Xeon", "®", "Scalable Processors"], ["5th Generation Intel  Xeon  Scalable processor", "4th Generation Intel  Xeon  Scalable processor"]),
    (processors.several_generations, ["5th Generation Intel", "Xeon", "4th Generation Intel", "Xeon", "Intel", "Xeon", "CPU Max Series", "TDP 350W"], ["5th Generation Intel  Xeon  processor", "4th Generation Intel  Xeon  processor", "Intel  Xeon  CPU Max Series"]),
    (processors.several_generations, ["14th Gen Intel", "Core Desktop Processor", "13th Gen Intel", "Core Desktop Processor", "Single Processor"], ["14th Generation Intel  Core Desktop processor", "13th Generation Intel  Core Desktop processor"]),
    (processors.several_generations, ["5th Generation Intel", "not a part", "4th Generation Intel", "Xeon"], ["5th Generation Intel", "not a part", "4th Generation Intel  Xeon  processor"]),
    (processors.several_generations, ["5th Generation Intel Xeon Scalable Processors", "4th Generation Intel Xeon Scalable Processors"], None),
    (processors.several_generations, ["Support for 5th Generation Intel", "Xeon", "4th Generation Intel", "Xeon"], None),
    (processors.several_generations, ["5th Generation Intel", "Xeon"], None),
    (processors.several_generations, ["5th Generation Intel", "a", "b", "c", "d", "Xeon", "4th Generation Intel", "Xeon"], ["5th Generation Intel", "a", "b", "c", "d", "4th Generation Intel  Xeon  processor"]),
    (processors.one_generation, ["5th Generation Intel", "®", "Xeon", "Scalable Processors", "TDP up to 350W"], ["5th Generation  Intel Xeon Scalable processor"]),
    (processors.one_generation, ["Intel", "Xeon", "W-3500", "* Please select carriers"], ["Intel  Xeon  W-3500  processors"]),
    (processors.one_generation, ["Intel", "Xeon", "CPU Max Series", "Intel", "Xeon", "W-2500"], ["Intel  Xeon  CPU Max Series", "Intel  Xeon  W-2500  processors"]),
    (processors.one_generation, ["plain words"], None),
    (processors.workstation_series, ["Intel", "Xeon", "W-3500", "Processors", "Intel®", "Xeon", "W-2500"], ["Intel Xeon W-3500 Processors", "Intel Xeon W-2500 Processors"]),
    (processors.workstation_series, ["Intel", "Xeon", "Processors"], None),
    (processors.complete_names, ["Intel® Xeon® Gold 6400 Processor", "AMD EPYC 9004 Series processors", "Intel Core i7 Processor Socket 1700"], ["Intel Xeon Gold 6400 Processor", "AMD EPYC 9004 Series processors"]),
    (processors.complete_names, ["Intel Xeon Gold 6400 Processor", "Intel"], None),
    (processors.mixed_tokens, ["Intel®", "Xeon®", "Processor E-2100/E-2200 series", "8th Gen. Intel Core™ i3/ Pentium®", "/ Celeron®", "TDP", "x", "y"], ["Intel Xeon Processor E-2200 series", "8th Generation  Intel Core i3 processors", "8th Generation Intel Pentium  processors", "8th Generation Intel Celeron  processors", "Intel  Xeon  Processor E-2100 series"]),
    (processors.mixed_tokens, ["Intel Xeon", "E-2200 Processors", "E-2100 processors", "9th Gen. Intel Core i3/ Pentium", "/ Celeron", "a", "b", "c"], ["Intel Xeon E-2200 Processors", "Intel Xeon E-2100 Processors", "9th Generation Intel Core i3 Processors", "9th Generation Intel Pentium Processors", "9th Generation Intel Celeron Processors"]),
    (processors.mixed_tokens, ["Intel Xeon", "E-2200 Processors", "9th Gen. Intel Core i3/ Pentium", "/ Celeron"], None),
    (processors.assembled_tokens, ["Intel®", "Xeon®", "Gold", "processor", "TDP 100W"], ["Intel Xeon processor"]),
    (processors.assembled_tokens, ["Intel Xeon", "D-1700", "processor families", "AMD", "EPYC", "processor"], ["Intel Xeon processor families AMD EPYC processor"]),
    (processors.assembled_tokens, ["Intel Xeon processor D-1700", "processor family", "x"], ["Intel Xeon processor D-1700 processor family"]),
    (processors.assembled_tokens, ["AMD EPYC 4004 Series Processors", "other"], None),
    (processors.assembled_tokens, ["x" * 60, "Intel", "processor"], None),
    (processors.lga_socket, ["LGA1700 socket: Support for the 14th, 13th and 12th Generation Intel® Core™, Pentium® Gold and\nCeleron® Processors*"], [f"{n} Generation Intel {b} processor" for n in ("14th", "13th", "12th") for b in ("Core", "Pentium Gold", "Celeron")]),
    (processors.lga_socket, ["LGA1700 socket"], None),
    (processors.lga_package, ["LGA1700 package:\n- 14th generation Intel Core processors / Intel Pentium processor\nIntel Celeron processors*\nother\n- 13th Generation Intel Core processors"], ["14th Generation Intel Core processors", "14th Generation Intel Pentium processors", "14th Generation Intel Celeron processors", "13th Generation Intel Core processors"]),
    (processors.lga_package, ["LGA1200 package: Support Intel Pentium processors\nIntel Core processors\nand 10th Generation"], ["10th Generation Intel Pentium processors", "Intel Core processors"]),
    (processors.lga_package, ["no socket", None], None),
    (processors.amd_socket, ["AMD Socket AM4, support for:\nAMD Ryzen 5000 / 3rd Gen Ryzen and Athlon processors\nfoot note"], ["AMD Ryzen 5000 Series", "3rd Generation AMD Ryzen", "AMD Athlon processor"]),
    (processors.amd_socket, ["AMD Socket AM4"], None),
    (processors.support_for, ["x", "Support for 10th Generation Intel Core i5 processors/Intel Core i3 Processors/ Pentium processor\nCeleron processors in the LGA1200 package (note)"], ["10th Generation Intel Core i5 processors", "10th Generation Intel Core i3 processors", "10th Generation Intel Pentium processor", "10th Generation Intel Celeron processors"]),
    (processors.support_for, ["Support for 10th Generation AMD Core X/other"], ["10th Generation Amd Core X"]),
    (processors.support_for, ["Support for 7th / 6th Generation Intel® Core™ i7 processors/Intel Core i5 processors in the LGA1151 package"], [f"{n} Generation Intel Core {k} processors" for n in ("7th", "6th") for k in ("i7", "i5")]),
    (processors.support_for, ["Support for Intel Core™ 14th gen Processors/ Pentium Processor (a)\nmore"], ["Intel Core 14th Generation processors", "Intel Pentium Processor"]),
    (processors.support_for, ["Supports Intel", None], None),
    (processors.d_series, ["Default CPU setting: Intel", "®", "Xeon", "®", "D-1700", "processor family", "Cache"], ["Intel Xeon D-1700 processor family"]),
    (processors.d_series, ["Intel", "Xeon", "D-1500", "Intel", "Xeon", "D-2100", "processors"], ["Intel Xeon D-1500", "Intel Xeon D-2100 processors"]),
    (processors.d_series, ["Intel", "Xeon", "D-1500", "processor"], None),
    (processors.d_series, ["D-1500", "Intel", "Xeon", "a processor", "b"], None),
]


def test_rules_one_by_one(spark):
    row = spark.range(1)
    texts = lambda xs: F.array(*(F.lit(x).cast("string") for x in xs))
    got = row.select(*(rule(F.filter(texts(xs), lambda x: x.isNotNull())).alias(f"c{i}") for i, (rule, xs, _) in enumerate(RULE_CASES[:14]))).collect()[0]
    got = [*got, *row.select(*(rule(F.filter(texts(xs), lambda x: x.isNotNull())).alias(f"c{i}") for i, (rule, xs, _) in enumerate(RULE_CASES[14:28]))).collect()[0]]
    got += row.select(*(rule(F.filter(texts(xs), lambda x: x.isNotNull())).alias(f"c{i}") for i, (rule, xs, _) in enumerate(RULE_CASES[28:]))).collect()[0]
    assert len(got) == len(RULE_CASES)
    for (rule, xs, want), have in zip(RULE_CASES, got):
        assert (have or None) == want, (rule.__name__, xs)
