"""Word lists, patterns and weights of the mining operators.

Operators take them as parameters, with these as defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# They decide which sequences, techniques and species are found.

#: Letters of amino acids.
AA = "ACDEFGHIKLMNPQRSTVWY"
MIN_LENGTH = 6
MAX_LENGTH = 120
#: Short sequences of these letters only read like words.
COMMON_LETTERS = "AEILNSTR"
CANDIDATE = r"\b[A-Z01]{3,120}(?:\s+[A-Z01]{3,120}){0,3}\b"
PMID_PATTERNS = [
    r"PMID[:\s]+(\d+)",
    r"PubMed\s+ID[:\s]+(\d+)",
    r"PubMed\s+Identifier[:\s]+(\d+)",
]
#: Sequences cut by a hyphen at a line end, by a hyphen in a line, into single letters, and by a hyphen before a line break.
HYPHEN_BREAK = rf"(?<=[{AA}])-\s*\n\s*(?=[{AA}])"
HYPHENATED = r"\b([A-Z01]{2,})-([A-Z01]{2,})\b"
SPACED_OUT = r"\b(?:[A-Z01][ \t\-]+){3,}[A-Z01]\b"
BROKEN = r"\b([A-Z01]{2,})-\s*\n\s*([A-Z01]{2,})\b"
#: START LETTERS [END]
NUMBERED_LINE = r"^\s*(\d+)\s+([A-Z\s]+?)(?:\s+(\d+))?\s*$"
#: Characters that OCR takes for others, and what they are.
OCR_CONFUSED, OCR_MEANT = "0O1I", "QQIL"
#: Lines below which sequences stand in tables, and words before and after a sequence that speak for it.
TABLE_HEADER = r"(?i)\b(peptide|sequence|residue|amino acid)\b"
WORDS_BEFORE, WORDS_AFTER = "peptide|sequence|residues?", "peptide|sequence|residues?|analyzed|purified|isolated"
#: Lines of the evaluation report.
REPORT_HEAD = ["Evaluation Report", "=================", ""]
REPORT_COUNTS = ["Total True Positives (TP)", "Total False Positives (FP)", "Total False Negatives (FN)"]
REPORT_SHARES = ["Precision", "Recall", "F1 Score"]
REPORT_TAIL = ["", "Per-PMID Results saved to metrics_by_pmid.csv"]
#: Names of genes.
GENE_NAME = r"^[A-Z]{2,6}\d{1,3}[A-Z]?$"
BACK_MATTER = ["Acknowledgments", "Acknowledgements", "References", "Literature Cited", "Bibliography"]

BLACKLIST = [
    "REFERENCES", "REFERENCE", "ARTICLE", "LETTER", "FASTA", "QIAGEN", "METHODS", "RESULTS", "DISCUSSION",
    "ABSTRACT", "SEQUENCE", "SEQUENCES", "PEPTIDE", "PEPTIDES", "PROTEIN", "PROTEINS", "AUTHOR", "AUTHORS",
    "JOURNAL", "EDITOR", "EDITORS", "REVIEW", "REVIEWS", "MERISTEMS", "ICREA", "RIKEN", "ADVANCE",
    "TECHNICAL", "MARKER", "FERRITIN", "CATALASE", "LACTATE", "DERIVATIVES", "SIGNIFICANCE", "TRANSCRIPTS",
    "ASSISTANCE", "RECEIVE", "ANGELA", "KATHARINA", "STACEY", "INTRODUCTION", "BACKGROUND", "CONCLUSION",
    "CONCLUSIONS", "MATERIALS", "EXPERIMENTAL", "SUPPLEMENTARY", "SUPPLEMENTAL", "FIGURE", "FIGURES", "TABLE",
    "TABLES", "LEGEND", "LEGENDS", "APPENDIX", "DATASET", "DATABASE", "GENOME", "GENOMIC", "GENE", "GENES",
    "MRNA", "CDNA", "DNA", "RNA", "PCR", "QPCR", "ELISA", "MALDI", "TOF", "SDS", "PAGE", "HPLC", "LCMS",
    "TRICINE", "EDMAN", "WESTERN", "BLOT", "SPECTROMETRY", "CHROMATOGRAPHY", "ARABIDOPSIS", "ESCHERICHIA",
    "BACILLUS", "STAPHYLOCOCCUS", "PSEUDOMONAS", "CANDIDA", "SUPPLEMENT", "SUPPLEMENTS",
]

SECTION_TITLES = [
    "ABSTRACT", "INTRODUCTION", "BACKGROUND", "RESULTS", "METHODS", "MATERIALS", "DISCUSSION", "CONCLUSION",
    "CONCLUSIONS", "REFERENCES", "ACKNOWLEDGMENTS", "ACKNOWLEDGEMENTS", "FIGURE", "TABLE", "SUPPLEMENTARY",
]

PEPTIDE_KEYWORDS = [
    "peptide",
    "peptides",
    "amino acid",
    "sequence",
    "synthetic peptide",
    "antimicrobial peptide",
    "residues",
    "purified peptide",
    "isolated peptide",
    "deduced peptide",
    "mature peptide",
    "precursor peptide",
    "fragment",
    "mass spectrometry",
    "ms/ms",
    "maldi",
    "edman",
    "n-terminal",
    "hplc",
]

TABLE_KEYWORDS = [
    "table",
    "supplementary file",
    "supplemental file",
    "fasta",
    "sequence column",
    "peptide sequence",
    "sequence",
    "amino acid sequence",
]

GENE_TERMS = ["gene", "genes", "mrna", "transcript", "transcripts", "cdna", "orf", "locus", "protein family", "domain"]
PEPTIDE_TERMS = ["peptide", "amino acid", "residue", "sequence", "mass spectrometry", "maldi", "edman"]

#: Techniques in the order in which they are looked for, with patterns in theirs.
TECHNIQUES = {
    "MALDI-TOF": [
        r"\bMALDI[\-\s]TOF(?!\s*MS)(?!\s*/)",
        r"\bMALDI\s+TOF(?!\s*MS)",
        r"matrix[\-\s]assisted\s+laser\s+desorption[/\\\s]ionization",
    ],
    "MALDI-TOF MS": [
        r"\bMALDI[\-\s]TOF[\-\s]MS\b",
        r"\bMALDI[\-\s]TOF\s+mass\s+spectrometry\b",
        r"\bMALDI[\-\s]TOF/TOF\b",
    ],
    "LC-MS/MS": [
        r"\bLC[\-\s]MS/MS\b",
        r"\bnano[\-\s]LC[\-\s]MS/MS\b",
        r"\bnanoLC[\-\s]MS/MS\b",
        r"\bliquid\s+chromatography[\-\s]tandem\s+mass\s+spectrometry\b",
        r"\bLC/MS/MS\b",
    ],
    "ESI-MS": [
        r"\bESI[\-\s]MS(?!/MS)\b",
        r"\belectrospray\s+ionization\s+mass\s+spectrometry\b",
        r"\belectrospray\s+mass\s+spectrometry\b",
    ],
    "ESI-QTOF": [
        r"\bESI[\-\s]QTOF\b",
        r"\bQ[\-]TOF\b",
        r"\bquadrupole\s+time[\-]of[\-]flight\b",
    ],
    "Orbitrap MS": [
        r"\bOrbitrap\b",
        r"\bFT[\-]ICR\s*MS\b",
        r"\bFourier\s+transform\s+ion\s+cyclotron\b",
    ],
    "Tandem MS": [
        r"\bMS/MS\b",
        r"\btandem\s+mass\s+spectrometry\b",
        r"\btriple\s+quadrupole\b",
        r"\bMS2\b",
    ],
    "Edman Sequencing": [
        r"\bEdman\s+degradation\b",
        r"\bEdman\s+sequencing\b",
        r"\bEdman\s+microsequencing\b",
        r"\bN[\-]terminal\s+sequencing\b",
    ],
    "Peptide Sequencing": [
        r"\bpeptide\s+sequencing\b",
        r"\bde\s+novo\s+sequencing\b",
        r"\bde\s+novo\s+peptide\s+sequencing\b",
        r"\bMS/MS\s+sequencing\b",
    ],
    "Protein Sequencing": [
        r"\bprotein\s+sequencing\b",
        r"\bN[\-]terminal\s+amino\s+acid\s+sequencing\b",
        r"\baminoacid\s+sequencing\b",
    ],
    "SDS-PAGE": [
        r"\bSDS[\-\s]PAGE\b",
        r"\bsodium\s+dodecyl\s+sulfate[\-\s]polyacrylamide\b",
    ],
    "Tricine SDS-PAGE": [
        r"\bTricine[\-\s]SDS[\-\s]PAGE\b",
        r"\bTricine\s+gel\b",
    ],
    "Native PAGE": [
        r"\bNative[\-\s]PAGE\b",
        r"\bBlue\s+Native\s+PAGE\b",
        r"\bnon[\-]denaturing\s+PAGE\b",
    ],
    "Agarose Gel": [
        r"\bagarose\s+gel\b",
        r"\bagarose\s+gel\s+electrophoresis\b",
    ],
    "Western Blot": [
        r"\bWestern\s+blot\b",
        r"\bWestern\s+blotting\b",
        r"\bimmunoblot\b",
        r"\bimmuno[\-]blot\b",
    ],
    "Immunoprecipitation": [
        r"\bimmunoprecipitation\b",
        r"\bco[\-]immunoprecipitation\b",
        r"\bCoIP\b",
    ],
    "ELISA": [
        r"\bELISA\b",
        r"\benzyme[\-]linked\s+immunosorbent\b",
    ],
    "Synthetic Peptide": [
        r"\bsynthetic\s+peptide\b",
        r"\bchemically\s+synthesized\s+peptide\b",
        r"\bpeptide\s+synthesis\b",
        r"\bpeptides?\s+were\s+synthesized\b",
        r"\bpeptide\s+purchased\s+from\b",
        r"\bGenScript\b",
        r"\bSmartox\b",
        r"\bGL\s+Biochem\b",
        r"\bPeptide\s+2\.0\b",
        r"\bThermo\s+Fisher\s+custom\s+peptide\b",
        r"\bAutomated\s+peptide\s+synthesizer\b",
        r"\bcustom\s+peptide\s+synthesis\b",
    ],
    "Solid Phase Peptide Synthesis": [
        r"\bSolid[\-\s]Phase\s+Peptide\s+Synthesis\b",
        r"\bSPPS\b",
        r"\bFmoc\s+chemistry\b",
        r"\bBoc\s+chemistry\b",
        r"\bFmoc[\-]based\s+synthesis\b",
    ],
    "Peptide Analog": [
        r"\bpeptide\s+analog\b",
        r"\bsynthetic\s+analog\b",
        r"\bbiotinylated\s+peptide\b",
        r"\bFITC[\-]labell?ed\s+peptide\b",
        r"\bfluorescent\s+peptide\b",
        r"\bfluorescein[\-]labell?ed\s+peptide\b",
    ],
    "RP-HPLC": [
        r"\bRP[\-]HPLC\b",
        r"\breverse[d]?[\-\s]phase\s+HPLC\b",
        r"\breverse[d]?[\-\s]phase\s+high[\-\s]performance\s+liquid\s+chromatography\b",
        r"\breverse[d]?[\-\s]phase\s+liquid\s+chromatography\b",
    ],
    "HPLC": [
        r"\bHPLC\b",
        r"\bhigh[\-]performance\s+liquid\s+chromatography\b",
        r"\bhigh[\-]pressure\s+liquid\s+chromatography\b",
    ],
    "Strong Cation Exchange HPLC": [
        r"\bstrong\s+cation\s+exchange\b",
        r"\bSCX[\-]HPLC\b",
        r"\bcation\s+exchange\s+HPLC\b",
    ],
    "Affinity Chromatography": [
        r"\baffinity\s+chromatography\b",
        r"\baffinity\s+purification\b",
        r"\bGST\s+pull[\-]down\b",
        r"\bHis[\-]tag\s+purification\b",
    ],
    "Size Exclusion Chromatography": [
        r"\bsize\s+exclusion\s+chromatography\b",
        r"\bSEC\b",
        r"\bgel\s+filtration\b",
    ],
    "Reverse Phase Chromatography": [
        r"\breverse[d]?[\-\s]phase\s+chromatography\b(?!.*HPLC)",
        r"\bRP\s+chromatography\b",
    ],
    "In vitro Translation": [
        r"\bin\s+vitro\s+translation\b",
        r"\bcell[\-]free\s+translation\b",
        r"\bRabbit\s+Reticulocyte\s+Lysate\b",
        r"\btranslation\s+assay\b",
    ],
    "Wheat Germ Translation": [
        r"\bwheat\s+germ\s+extract\b",
        r"\bwheat\s+germ\s+translation\b",
        r"\bwheat[\-]germ\s+cell[\-]free\b",
    ],
    "Site-Directed Mutagenesis": [
        r"\bsite[\-]directed\s+mutagenesis\b",
        r"\bsite[\-]specific\s+mutagenesis\b",
        r"\bpoint\s+mutation\b",
    ],
    "RT-PCR": [
        r"\bRT[\-]PCR\b",
        r"\breverse\s+transcription\s+PCR\b",
        r"\bqRT[\-]PCR\b",
    ],
    "Ribosome Profiling": [
        r"\bribosome\s+profiling\b",
        r"\bRibo[\-]seq\b",
        r"\bpolysome\s+profiling\b",
    ],
    "Pull-down Assay": [
        r"\bpull[\-]down\s+assay\b",
        r"\bpull\s+down\s+assay\b",
        r"\bGST[\-]pull[\-]down\b",
        r"\bHis[\-]pull[\-]down\b",
    ],
    "NMR": [
        r"\bNMR\b",
        r"\bnuclear\s+magnetic\s+resonance\b",
    ],
    "Circular Dichroism": [
        r"\bcircular\s+dichroism\b",
        r"\bCD\s+spectroscopy\b",
        r"\bCD\s+spectra\b",
    ],
    "X-ray Crystallography": [
        r"\bX[\-]ray\s+crystal\w*\b",
        r"\bprotein\s+crystallography\b",
    ],
    "Cryo-EM": [
        r"\bcryo[\-]EM\b",
        r"\bcryo[\-]electron\s+microscopy\b",
    ],
}

#: A specific technique and the general ones that it makes redundant.
SUPERSEDES = {
    "MALDI-TOF MS": ["MALDI-TOF", "Tandem MS"],
    "LC-MS/MS": ["Tandem MS", "HPLC"],
    "RP-HPLC": ["HPLC"],
    "Tricine SDS-PAGE": ["SDS-PAGE"],
    "Wheat Germ Translation": ["In vitro Translation"],
    "Solid Phase Peptide Synthesis": ["Synthetic Peptide"],
    "Peptide Analog": [],
    "ESI-QTOF": ["ESI-MS"],
    "Orbitrap MS": ["Tandem MS"],
    "Strong Cation Exchange HPLC": ["HPLC"],
}

EVIDENCE_WEIGHTS = {
    "Synthetic Peptide": 2,
    "Peptide Analog": 2,
    "In vitro Translation": 3,
    "Wheat Germ Translation": 3,
    "Site-Directed Mutagenesis": 3,
    "RT-PCR": 2,
    "MALDI-TOF": 4,
    "MALDI-TOF MS": 4,
    "ESI-MS": 4,
    "ESI-QTOF": 4,
    "Tandem MS": 4,
    "Orbitrap MS": 4,
    "LC-MS/MS": 5,
    "Edman Sequencing": 5,
    "Peptide Sequencing": 5,
    "Protein Sequencing": 5,
    "SDS-PAGE": 3,
    "Tricine SDS-PAGE": 3,
    "Native PAGE": 2,
    "Western Blot": 5,
    "Immunoprecipitation": 4,
    "Pull-down Assay": 4,
    "ELISA": 3,
    "RP-HPLC": 3,
    "HPLC": 2,
    "Strong Cation Exchange HPLC": 3,
    "Affinity Chromatography": 2,
    "Size Exclusion Chromatography": 2,
    "Solid Phase Peptide Synthesis": 2,
    "NMR": 4,
    "Circular Dichroism": 3,
    "X-ray Crystallography": 4,
    "Cryo-EM": 4,
    "Ribosome Profiling": 2,
}

SPECIES = {
    "Arabidopsis thaliana": [
        r"\bArabidopsis\s+thaliana\b",
        r"\bA\.\s*thaliana\b",
        r"\bArabidopsis\b",
    ],
    "Medicago truncatula": [
        r"\bMedicago\s+truncatula\b",
        r"\bM\.\s*truncatula\b",
    ],
    "Glycine max (soybean)": [
        r"\bGlycine\s+max\b",
        r"\bsoybean\b",
        r"\bG\.\s*max\b",
    ],
    "Zea mays (maize)": [
        r"\bZea\s+mays\b",
        r"\bmaize\b",
        r"\bcorn\b",
        r"\bZ\.\s*mays\b",
    ],
    "Oryza sativa (rice)": [
        r"\bOryza\s+sativa\b",
        r"\brice\b",
        r"\bO\.\s*sativa\b",
    ],
    "Solanum lycopersicum (tomato)": [
        r"\bSolanum\s+lycopersicum\b",
        r"\btomato\b",
        r"\bS\.\s*lycopersicum\b",
    ],
    "Nicotiana tabacum (tobacco)": [
        r"\bNicotiana\s+tabacum\b",
        r"\btobacco\b",
        r"\bN\.\s*tabacum\b",
    ],
    "Nicotiana benthamiana": [
        r"\bNicotiana\s+benthamiana\b",
        r"\bN\.\s*benthamiana\b",
    ],
}

DOCUMENT_TECHNIQUES = {
    "RACE-PCR": [
        r"\bRACE[\-\s]PCR\b",
        r"\brapid\s+amplification\s+of\s+cDNA\s+ends\b",
    ],
    "GUS Reporter Assay": [
        r"\bGUS\s+(?:reporter|gene)\b",
        r"\bbeta[\-\s]*glucuronidase\s+reporter\b",
        r"\b\u03b2[\-\s]*glucuronidase\s+reporter\b",
        r"\bpromoter[\-\s]GUS\b",
    ],
    "In Vitro Translation": [
        r"\bin\s+vitro\s+translation\b",
        r"\bwheat\s+germ\s+extract\b",
    ],
    "Western Blot": [
        r"\bWestern\s+blot(?:ting)?\b",
        r"\bimmunoblot(?:ting)?\b",
    ],
    "Peptide Mass Fingerprinting": [
        r"\bpeptide\s+mass\s+fingerprinting\b",
        r"\bPMF\b",
    ],
}

REFERENCE_CONTEXTS = [
    "The synthetic peptide was analyzed via mass spectrometry.",
    "Peptides were synthesized by solid-phase peptide synthesis and purified by HPLC.",
    "The translated product of the open reading frame encodes a short peptide.",
    "Amino acid sequence of the mature peptide was determined by Edman degradation.",
    "Two radiolabeled in vitro translation products of 12-aa and 24-aa residues were obtained.",
    "The identified sequence corresponds to an antimicrobial peptide.",
    "Signal peptide cleavage site was predicted based on the sequence.",
    "The purified fraction exhibited strong peptide activity.",
]

# End of fixed values.


def as_table(spark: SparkSession, patterns: dict[str, list[str]]) -> DataFrame:
    """(name, name_no, pattern_no, pattern): a pattern lexicon as a small table."""
    rows = [(name, i, j, p) for i, (name, own) in enumerate(patterns.items()) for j, p in enumerate(own)]
    return spark.createDataFrame(rows, "name string, name_no int, pattern_no int, pattern string")
