"""Defaults a user of the reference needs to reproduce its runs.

# FIXED VALUES (must equal the reference's for the same results).
# The brand terms the reference scores, as one comma-separated string in its
# order; ``normalize_terms`` lower-cases it and deletes spaces. 29 listed, 28
# distinct after lower-casing; the three holding '_' can never match a cleaned
# token (cleaning turns '_' into a space), so 25 are reachable.
"""

REFERENCE_TERMS = (
    "americanair, virginamerica, southwestair, delta, klm, alaskaair, jetblue, emirates, asianaairlines, "
    "qatarairways, aircanada, latamairlinesus, etihadairways, JetBlue, AirAsia, flyPAL, turkishairlines, "
    "British_Airways,westjet, SingaporeAir, cathaypacific, EVAAirUS,FlyANA_official, iQantas, lufthansa, "
    "HK_Airlines, airfrance, taportugal, AeromexicoUSA"
)
