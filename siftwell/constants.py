"""Fixed values that results depend on, as the published sources state them."""

from __future__ import annotations

# --- Fixed values: names -------------------------------------------------------------------------------------------------------

#: Greek letters and the names that replace them, in either case.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "κ": "kappa", "λ": "lambda", "μ": "mu", "ω": "omega"}
VARIANTS = ("exact", "compact", "singular", "stereo_stripped")
STRICT_VARIANTS = ("exact", "compact")
#: Tokens that lead a name and say only its stereochemistry.
LEADING_STEREO_TOKENS = ("d", "l", "dl", "ld", "rs", "sr", "cis", "trans", "alpha", "beta", "gamma", "delta")
#: Tokens that one of two like names may have more than the other.
IGNORABLE_FUZZY_TOKENS = (
    "e", "z", "r", "s", "zwitterion", "anion", "cation", "hydrate", "monohydrate", "dihydrate", "trihydrate", "hydrochloride", "hydrobromide", "hydroiodide",
    "hemihydrate", "sesquihydrate", "sodium", "disodium", "trisodium", "potassium", "dipotassium", "tripotassium",
)
#: Weights of alias sources; any other source weighs 0.
ALIAS_SOURCE_WEIGHTS = {
    "compound_name": 0.10,
    "ascii_name": 0.08,
    "chebi_synonym": 0.07,
    "chebi_iupac": 0.06,
    "chebi_inn": 0.05,
    "pubchem_synonym": 0.05,
    "plantcyc_common_name": 0.07,
    "plantcyc_synonym": 0.05,
    "aracyc_common_name": 0.08,
    "aracyc_synonym": 0.06,
    "lipidmaps_common_name": 0.08,
    "lipidmaps_systematic_name": 0.06,
    "lipidmaps_synonym": 0.05,
}
VARIANT_BASE_SCORES = {"exact": 0.84, "compact": 0.81, "singular": 0.79, "stereo_stripped": 0.77}
FUZZY_VARIANT_BASE_SCORES = {"exact": 0.78, "singular": 0.76, "stereo_stripped": 0.74}
#: Most records that a name may stand for, synonyms taken from a record, PubChem names of a CID.
NAME_CAP, RECORD_SYNONYMS, PUBCHEM_SYNONYMS = 5, 10, 15

# --- Fixed values: categories of pathways and compounds -------------------------------------------------------------------------

CATEGORY_PATTERNS = (
    ("Biosynthesis", r"\bbiosynthesis\b"),
    ("Degradation", r"\bdegradation\b"),
    ("Detoxification", r"\bdetoxification\b"),
    ("Inactivation", r"\binactivation\b"),
    ("Metabolism", r"\bmetabolism\b"),
    ("Signaling", r"\bsignaling\b|\bsignal\b"),
    ("Transport", r"\btransport\b"),
    ("Salvage", r"\bsalvage\b"),
    ("Interconversion", r"\binterconversion\b|\bconversion\b"),
    ("Modification", r"\bmodification\b|\bmethylation\b|\bacylation\b|\bglycosylation\b"),
    ("Cycle", r"\bcycle\b"),
    ("Photosynthesis", r"\bphotosynthesis\b|\bphotorespiration\b"),
    ("Fermentation", r"\bfermentation\b"),
    ("Fixation", r"\bfixation\b"),
    ("Assimilation", r"\bassimilation\b"),
)
COFACTOR_IDS = (
    "WATER", "OXYGEN-MOLECULE", "CARBON-DIOXIDE", "PROTON",
    "ATP", "ADP", "AMP", "NAD", "NADH", "NAD-P-OR-NOP",
    "NADP", "NADPH", "CO-A", "Pi", "PPI", "FAD", "FADH2",
)
COFACTOR_NAME_TOKENS = (
    "atp", "adp", "amp", "nadh", "nadph", "nadp", "nad", "water",
    "oxygen", "coenzyme a", "phosphate", "pyrophosphate", "carbon dioxide",
    "proton", "h+", "h2o", "o2", "co2",
)
SEMANTIC_CLASS_PATTERNS = {
    "lipid": r"\blipid|fatty acid|acylglycerol|sphingo|ceramide|phospholipid|glycerolipid",
    "amino_acid": r"\bamino.?acid|aminoacid|\b[dl]-(?:ala|arg|asn|asp|cys|glu|gln|gly|his|ile|leu|lys|met|phe|pro|ser|thr|trp|tyr|val)\b",
    "organic_acid": r"\borganic.?acid|carboxylic.?acid|dicarboxylic|tricarboxylic",
    "carbohydrate": r"\bcarbohydrate|sugar|saccharide|hexose|pentose|glucose|fructose|sucrose|galactose",
    "nucleotide": r"\bnucleotide|nucleoside|purine|pyrimidine|\b[ATGCU][DM]P\b",
    "peptide": r"\bpeptide|dipeptide|tripeptide|oligopeptide|polypeptide",
    "phenylpropanoid": r"\bphenylpropanoid|cinnam|coumar|lignin|lignan|sinapyl|coniferyl|ferulic",
    "flavonoid": r"\bflavon|isoflavon|anthocyanin|chalcone|aurone|catechin|flavan|flavanol|flavanone|quercetin|kaempferol|naringenin|luteolin|apigenin",
    "alkaloid": r"\balkaloid|indole|quinoline|isoquinoline|tropane|pyrrolizidine|piperidine|purine.?alkaloid",
    "terpenoid": r"\bterpene|terpenoid|monoterpene|sesquiterpene|diterpene|triterpene|isoprene|carotenoid|sterol|gibberellin",
    "cofactor_like": r"\bcofactor|coenzyme|\bNAD|\bFAD|\bFMN|thiamine|riboflavin|pyridoxal|biotin|folate|cobalamin|pantothen",
    "hormone_related": r"\bhormone|auxin|cytokinin|abscisic|brassinosteroid|jasmonate|salicylate|ethylene.?(?:biosyn|signal)",
}
CLASS_KEYWORDS = {
    "lipid": ("lipid", "fatty", "sphingolipid", "glycerolipid", "glycerophospholipid", "wax", "cutin", "suberin"),
    "amino_acid": ("amino", "alanine", "arginine", "asparagine", "aspartate", "cysteine", "glutamate", "glutamine", "glycine", "histidine", "isoleucine", "leucine", "lysine", "methionine", "phenylalanine", "proline", "serine", "threonine", "tryptophan", "tyrosine", "valine"),
    "carbohydrate": ("carbohydrate", "sugar", "glycolysis", "gluconeogenesis", "starch", "sucrose", "galactose", "fructose", "pentose", "mannose"),
    "nucleotide": ("nucleotide", "purine", "pyrimidine"),
    "phenylpropanoid": ("phenylpropanoid", "lignin", "lignan", "coumarin", "stilbenoid", "monolignol"),
    "flavonoid": ("flavonoid", "isoflavonoid", "anthocyanin", "flavone", "flavonol"),
    "terpenoid": ("terpenoid", "terpene", "carotenoid", "sterol", "brassinosteroid", "gibberellin", "monoterpenoid", "sesquiterpenoid", "diterpenoid", "triterpenoid"),
    "alkaloid": ("alkaloid", "indole", "tropane", "glucosinolate"),
}
PLANT_CONTEXT_TAGS = ("primary_metabolism", "secondary_metabolism", "hormone_related", "stress_related", "development_related", "transport_related")
PRIMARY_BRITE_KEYWORDS = ("carbohydrate metabolism", "amino acid metabolism", "lipid metabolism", "nucleotide metabolism", "energy metabolism", "metabolism of cofactors and vitamins", "glycan biosynthesis")
SECONDARY_BRITE_KEYWORDS = ("biosynthesis of other secondary metabolites", "xenobiotics biodegradation")
SECONDARY_NAME_KEYWORDS = ("flavonoid", "phenylpropanoid", "terpenoid", "alkaloid", "glucosinolate", "anthocyanin")
HORMONE_KEYWORDS = ("auxin", "cytokinin", "gibberellin", "abscisic", "brassinosteroid", "ethylene", "jasmon", "salicyl")
STRESS_KEYWORDS = ("glutathione", "detox", "pathogen", "defense", "defence", "stress", "oxidative")
DEVELOPMENT_KEYWORDS = ("development", "morphogenesis", "meristem", "embryo", "seed")
TRANSPORT_KEYWORDS = ("transport", "transporter", "membrane transport")

# --- Fixed values: matching and resolution ---------------------------------------------------------------------------------------

#: Sources of cross-references by id.
XREF_KEGG, XREF_PUBCHEM, XREF_HMDB, XREF_CHEMSPIDER = "45", "68", "35", "19"
EXACT_BRIDGE_SCORES = {"inchikey": 1.00, "chebi_xref": 0.98, "kegg_xref": 0.95}
STRUCTURE_WEIGHT, STRUCTURE_LEAST = 0.85, 0.85
NAME_MATCH_SCORES = {"exact": 0.80, "compact": 0.76, "singular": 0.73, "stereo_stripped": 0.70}
FALLBACK_SCORES = {"chebi_xref": 1.00, "kegg_xref": 0.95, "inchikey": 0.90}
FALLBACK_DISCOUNT = 0.85
FUZZY_LEAST, FUZZY_AUTO, FUZZY_GAP, FUZZY_SHORTEST, FUZZY_SUGGESTIONS = 0.85, 0.88, 0.05, 6, 5
SMILES_LEAST, RECOVERED_LEAST, BLOCK_SIMILARITY, MOST_NEIGHBORS = 0.60, 0.85, 0.90, 20
MATCH_TYPE_PRIORITY = {"direct": 5, "exact_structure": 4, "fuzzy": 3, "recovered_from_chebi": 2, "structural_neighbor": 1}
#: Base scores of bridges to KEGG by method, for AraCyc and PlantCyc.
PLANT_BRIDGE_BASE_SCORES = {
    "plant_direct_kegg_xref": (0.955, 0.935),
    "plant_via_chebi": (0.930, 0.910),
    "plant_inchikey_exact": (0.920, 0.900),
    "plant_via_pubchem": (0.900, 0.880),
    "plant_smiles_exact": (0.890, 0.870),
}
GENERIC_KEGG_MAPS = ("map01100", "map01110", "map01120")
