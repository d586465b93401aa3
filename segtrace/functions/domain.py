"""Fixed domain values: influenza A segments, thresholds, mutations of interest, alias lists."""

from __future__ import annotations

# Segment acronyms in the order of their numbers 1 to 8.
SEGMENTS = ("PB2", "PB1", "PA", "HA", "NP", "NA", "MP", "NS")

# Accepted lengths in nucleotides, for reports.
LENGTHS = {
    "PB2": (2226, 2370),
    "PB1": (2211, 2379),
    "PA": (2294, 2606),
    "HA": (1640, 1804),
    "NP": (1431, 1607),
    "NA": (1364, 1488),
    "MP": (952, 1032),
    "NS": (798, 906),
}
# The same for database updates, which differ for one segment.
UPDATE_LENGTHS = LENGTHS | {"PA": (2065, 2294)}

# Mutations of interest by segment.
MUTATIONS = {
    "PB2": ("9N", "199S", "271A", "292V", "526R", "588I", "588V", "591K", "591R", "627K", "627V", "631L", "701N", "702N", "740N"),
    "PB1": ("66S",),
    "PA": ("38T", "85I", "97I", "186S", "336M", "356R", "552S"),
    "HA": ("156A", "156V", "186D", "186V", "208T", "221D", "222L", "224S"),
    "NP": ("52H", "52N", "100I", "100V", "283P", "313V", "313Y"),
    "NA": ("119V", "223V", "275Y", "292K", "399R", "432E"),
    "MP": ("27A", "31N", "95K"),
}
# Mutations shown under another locus than their segment.
LOCUS_OF = {("PB1", "66S"): "PB1-F2", ("MP", "95K"): "M1", ("MP", "31N"): "M2", ("MP", "27A"): "M2"}
# Locus names that belong to a segment of another name.
SEGMENT_OF_LOCUS = {
    "PB1-F2": "PB1", "PA-X": "PA", "HA1-5": "HA", "HA2-5": "HA", "NA-1": "NA", "NA-2": "NA", "M1": "MP", "M2": "MP", "NS-1": "NS", "NS-2": "NS",
}
# Order of loci in reports.
LOCUS_ORDER = ("PB2", "PB1", "PB1-F2", "PA", "PA-X", "HA", "NP", "NA", "M1", "M2")

# Words for each segment number, tried in this order.
SEGMENT_WORDS = (
    ("PB2", "segment 1", "segment: 1", "chromossome: 1"),
    ("PB1", "segment 2", "PB1-F2", "segment: 2"),
    ("PA", "segment 3", "PA-X", "segment: 3"),
    ("hemagglutinin", "haemagglutinin", "HA1", "HA2", "HA", "segment 4", "segment: 4"),
    ("NP", "segment 5", "nucleocapside protein", "segment: 5"),
    ("neuraminidase", "NA", "segment 6", "segment: 6"),
    ("segment 7", "M1", "M2", "matrix protein", "segment: 7"),
    ("segment 8", "NS1", "NS2", "NEP", "nonstructural protein", "nuclear export protein", "segment: 8"),
)
# Subtypes that are sent to clade assignment.
CLADE_SUBTYPES = ("H1", "H3", "H5")
# Fixed value: the clade that qualifies for constellation typing.
CONSTELLATION_CLADE = "2.3.4.4b"
# Segments in a constellation row.
CONSTELLATION_SEGMENTS = ("PB2", "PB1", "PA", "NP", "NA", "MP", "NS")
# Columns of one sample's batch summary.
SUMMARY_FIELDS = (
    "input_file", "file_tag", "status", "error", "sample_dir", "reports_dir_rel", "flumut_ran", "nextclade_ran", "genin2_ran", "clade", "genotype",
    "genin2_genotype", "genin2_subgenotype", "genin2_pb2", "genin2_pb1", "genin2_pa", "genin2_np", "genin2_na", "genin2_mp", "genin2_ns",
    "mutations_of_interest",
)
# Continent of each region of the Americas, and a spelling used in reports.
AMERICAS = {"Northern America": "North America", "Central America": "North America", "Caribbean": "North America", "South America": "South America"}
REGION_SPELLING = {"South-eastern Asia": "South-Eastern Asia"}
# Names of the seven taxonomy slots in order.
RANKS = ("species", "genus", "subfamily", "family", "division", "order", "class")
# Search settings (identity of clusters, of representative hits, hits kept, contig floor and step).
CLUSTER_IDENTITY, REPRESENTATIVE_IDENTITY, MAX_TARGETS, CONTIG_FLOOR, CONTIG_STEP = 0.99, 90.0, 5, 125, 50
