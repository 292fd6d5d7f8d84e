"""A work folder of a few compounds and records that meets every tier and trap once."""

import gzip
import zipfile
from pathlib import Path


def _tsv(header, rows):
    return "\n".join(["\t".join(header)] + ["\t".join(map(str, r)) for r in rows]) + "\n"


def make(root: Path) -> str:
    refs = root / "refs"
    refs.mkdir(parents=True)
    plain = lambda path, text: path.write_text(text, encoding="utf-8")

    def gz(path, text):
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)

    compounds = [
        (1, "CHEBI:1", "D-glucose", "", "a sugar", 3, 1, ""), (2, "CHEBI:2", "camphor", "", "", 3, 1, 1), (3, "CHEBI:3", "β-thing's", "beta-things", "", "", 1, 1),
        (4, "CHEBI:4", "fancy berries", "", "", 2, 1, 2), (5, "CHEBI:5", "plant thing", "", "", 3, 1, 99), (6, "CHEBI:6", "nothing known", "", "", 3, 1, 7), (7, "CHEBI:7", "shape one", "", "", 3, 1, 6),
        (8, "CHEBI:8", "common name", "", "", 3, 1, ""),
    ]
    plain(root / "compounds.tsv", _tsv(["id", "chebi_accession", "name", "ascii_name", "definition", "stars", "status_id", "parent_id"], compounds))
    plain(root / "comments.tsv", _tsv(["id", "datatype"], [(1, "a"), (2, ""), (3, "a")]))
    names = [
        (1, "SYNONYM", "en", "dextrose", ""), (1, "IUPAC NAME", "en", "Dextrose", ""), (1, "SYNONYM", "de", "Traubenzucker", ""), (1, "BRAND", "en", "Glucosol", ""), (2, "INN", "", '"bornan" 2-one', "bornan-2-one"),
        (99, "SYNONYM", "en", "stray", ""), (3, "SYNONYM", "en", "thing", ""),
    ]
    gz(refs / "names.tsv.gz", _tsv(["compound_id", "type", "language_code", "name", "ascii_name"], names))
    xrefs = [(1, "C00031", 45, "X"), (1, "x", 45, "X"), (1, "5793", 68, "MANUAL_X_REF"), (1, "999", 68, "OTHER"), (1, "0001", 35, "X"), (3, "C00009", 45, "X"), (3, "C00005", 45, "X"), (5, "C11111", 45, "X")]
    gz(refs / "database_accession.tsv.gz", _tsv(["compound_id", "accession_number", "source_id", "type"], xrefs))
    data = [(1, 2, "C6H12O5", 164.0, "", ""), (1, 1, "C6 H12 O6", 180.06, 180.2, "0"), (1, 1, "later", 1, "", ""), (7, 1, "C9H9", "", 117.1, "-1.0")]
    gz(refs / "chemical_data.tsv.gz", _tsv(["compound_id", "status_id", "formula", "monoisotopic_mass", "mass", "charge"], data))
    structures = [(1, "false", 1, "CC", "i", "OLDKEY"), (1, "true", 1, "OCC", "InChI=1", "AAAAAAAAAAAAAA-BBBBBBBBBB-N"), (7, "true", 1, "CCC", "", "ccccCCCCCCCCCC-DDDDDDDDDD-N")]
    gz(refs / "structures.tsv.gz", _tsv(["compound_id", "default_structure", "status_id", "smiles", "standard_inchi", "standard_inchi_key"], structures))
    columns = ["Compound_id", "Compound_common_name", "Compound_synonyms", "Chemical_formula", "Smiles", "Links", "Pathway", "EC", "Reaction_equation", "InChI_key", "Fingerprint"]
    ara = [
        ("GLC", "glucose record", "dextrose*grape sugar", "C6H12O6", "OCC", "CHEBI:1;PUBCHEM:5793;HMDB:7", "sugar biosynthesis", "EC-1.1.1.1", "a -> b", "aaaaaaaaaaaaaa-BBBBBBBBBB-N", ""),
        ("GLC", "ignored", "third name", "X", "", "", "Glucose degradation I", "", "", "", ""),
        ("GLC", "", "", "", "", "", "sugar biosynthesis", "EC-2.7.1.2", "b -> c", "", ""),
        ("CAMPHOR", "camphor ester", "", "", "", "CHEBI:2", "camphor degradation", "", "", "", ""),
        ("CAMPHOR2", "camphor again", "", "", "", "CHEBI:2", "", "", "", "", ""),
        ("BETA", "beta record", "", "", "", "KEGG:C00005|LIGAND-CPD:C00009x", "unlisted pathway", "", "", "", ""),
        ("GAMMA", "gamma record", "", "", "", "KEGG:C00009", "sugar biosynthesis", "", "", "", ""),
        ("BERRY", "Fancy <i>Berry</i>", "", "", "", "", "sugar biosynthesis", "", "", "", ""),
        ("SHAPE", "shape record", "", "c9h9", "CCC", "", "Sugar Biosynthesis!", "", "", "", "15 0"),
        ("LONE", "Lone «é» record", "alone;solo", "", "", "CHEBI:77", "sugar biosynthesis", "", "", "", ""),
        *[(f"COMMON{k}", "common name", "", "", "", "", "sugar biosynthesis", "", "", "", "") for k in range(6)],
    ]
    plain(refs / "aracyc_compounds.20200101", _tsv(columns, ara[:1]))
    plain(refs / "aracyc_compounds.20240101", _tsv(columns, ara))
    plant = [("PT", "plant thing record", "", "", "", "CHEBI:5", "plant pathway", "", "", "", ""), ("PT2", "plant thing two", "", "", "", "KEGG:C11111;CHEBI:CHEBI:5", "other plant pathway", "", "", "", "")]
    plain(refs / "plantcyc_compounds.20240101", _tsv(columns, plant))
    pathway_columns = ["Pathway-id", "Pathway-name", "Reaction-id", "EC", "Gene-id", "Gene-name", "Protein-id"]
    pathways = [
        ("PWY-1", "sugar biosynthesis", "R1", "EC-9.9.9.9", "AT1G00001", "g1", "p1"), ("PWY-1", "other name", "R2", "", "AT1G00002", "g2", ""), ("PWY-1", "", "R2", "", "AT1G00003", "", ""),
        ("PWY-2", "Glucose degradation I", "R3", "", "AT1G00001", "", ""), ("PWY-2", "", "", "", "AT1G00009", "", ""), ("PWY-3", "camphor degradation", "", "", "", "", ""),
    ]
    plain(refs / "aracyc_pathways.20240101", _tsv(pathway_columns, pathways))
    plain(refs / "plantcyc_pathways.20240101", _tsv(pathway_columns, [("PLANT-1", "Sugar-Biosynthesis", "R9", "", "AT9", "", ""), ("PLANT-2", "plant pathway", "R8", "", "ATX", "", ""), ("PLANT-3", "Plant Pathway", "", "", "", "", "")]))
    sdf = "m\n> <LM_ID>\nLM1\n\n> <COMMON_NAME>\nsweet lipid\n\n> <SYNONYMS>\nsweet; fat\n\n> <PUBCHEM_CID>\n42\n\n> <CHEBI_ID>\n1\n\n$$$$\nm\n> <COMMON_NAME>\nno id\n\n$$$$\n"
    with zipfile.ZipFile(refs / "lmsd_extended.sdf.zip", "w") as z:
        z.writestr("a.sdf", sdf)
        z.writestr("b.sdf", sdf.replace("LM1", "LM2"))
    gz(refs / "pubchem_cid_synonym_filtered.gz", "5793\tCHEBI:4167\n5793\tDextrose\n5793\tcorn sugar\n5793\tCorn-Sugar\n1\tskipped\n42\tABC123456\n42\tsweet thing\n")
    plain(refs / "go-basic.obo", "format: 1\n\n[Term]\nid: GO:0000001\nname: sweet process\nnamespace: biological_process\n\n[Term]\nid: GO:0000002\nname: other\nnamespace: molecular_function\n")
    gaf = lambda gene, term, qualifier="", aspect="P": "\t".join(["TAIR", "x", gene, qualifier, term, "r", "e", "w", aspect, "n", ""])
    rows = [gaf(f"AT1G0000{k}", "GO:0000001") for k in (1, 2, 3)] + [gaf(f"AT2G0000{k}", "GO:0000002") for k in range(1, 8)] + [gaf("AT3G00001", "GO:0000001", "NOT|x"), gaf("AT3G00002", "GO:0000001", "", "F")]
    gz(refs / "gene_association.tair.gz", "!c\n" + "\n".join(rows) + "\n")
    reactome = [("R-1", "Sugar biosynthesis pathway", "Arabidopsis thaliana", "Metabolism", "about sugar"), ("R-2", "camphor", "Oryza", "", "")]
    plain(refs / "plant_reactome_pathways.tsv", _tsv(["pathway_id", "pathway_name", "species", "top_level_category", "description"], reactome))
    plain(refs / "plant_reactome_gene_pathway.tsv", _tsv(["pathway_id", "gene_id"], [("R-1", "at1g00001"), ("R-1", "AT1G00002"), ("R-1", ""), ("R-2", "AT9G99999")]))
    plain(refs / "kegg_pathway_ath.tsv", "ath00010\tSugar biosynthesis - Arabidopsis thaliana (thale cress)\nath00020\tCamphor world - Arabidopsis thaliana (thale cress)\n")
    plain(refs / "kegg_ath_gene_pathway.tsv", "ath:AT1G00001\tpath:ath00010\nath:AT1G00002\tpath:ath00010\nath:AT1G00002\tpath:ath00010\nath:AT5G00001\tpath:ath00020\n")
    plain(refs / "kegg_compound_pathway.tsv", "cpd:C00031\tpath:map00010\ncpd:C00009\tpath:map00020\ncpd:C00031\tpath:map01100\n")
    plain(refs / "kegg_pathway_map.tsv", "map00010\tSugar biosynthesis\nmap00020\tCamphor world\nmap01100\tMetabolic pathways\n")
    plain(refs / "kegg_pathway_hierarchy.txt", "+C\nAMetabolism\nB Carbohydrate metabolism\nC    00010  Sugar biosynthesis\nB Other\nC    00020  Camphor world\n")
    plain(refs / "kegg_compound_list.tsv", "C00031\tD-Glucose; Grape sugar; Dextrose\nC00009\tBeta thing; phosphate one\nC00099\tFancy berry\n")
    plain(refs / "ReactomePathways.txt", "R-HSA-1\tSugar biosynthesis\tHomo sapiens\nR-ATH-1\tSugar Biosynthesis\tArabidopsis thaliana\n")
    return str(root)


def read_tsv(path: str) -> list[dict[str, str]]:
    """The rows of a written table, in the order of its parts."""
    rows = []
    for part in sorted(Path(path).glob("part-*")):
        header, *lines = part.read_text(encoding="utf-8").split("\n")[:-1]
        rows += [dict(zip(header.split("\t"), line.split("\t"), strict=True)) for line in lines]
    return rows
