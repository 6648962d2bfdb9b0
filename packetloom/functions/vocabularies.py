"""Published code tables, index lists and constants, stated plainly."""

# Subcarriers of the legacy and high-throughput training fields.
L_LTF_INDICES = [*range(6, 32), *range(33, 59)]
HT_LTF_INDICES = [*range(66, 94), *range(95, 123)]

# Null carriers to remove.
NULL_20MHZ = [0, 1, 2, 3, 32, 61, 62, 63]
NULL_80MHZ = [*range(0, 6), *range(127, 131), *range(251, 256)]
NULL_80MHZ_INDUSTRIAL = [
    *range(0, 6), 32, *range(59, 70), 96, *range(123, 134), 160, *range(187, 198), 224,
    *range(251, 256)]
NULL_256_BINS = [0, 1, 2, 3, 4, 5, 127, 128, 129, 251, 252, 253, 254, 255]
NULL_2048_BINS = [
    *range(0, 12), *range(509, 515), *range(1013, 1036), *range(1535, 1540), *range(2036, 2048)]

# Fixed values: (mean, standard deviation) of published normalisations.
NTU_FI_NORMALIZATION = (42.3199, 4.9802)
WIDAR_NORMALIZATION = (0.0025, 0.0119)
WIFI_TAD_SCALE = 40.0

# Carrier counts that mark an axis as the subcarrier axis.
CSI_BENCH_CARRIERS = [56, 64, 114, 168, 208, 232]
CSI_BENCH_LAST_AXIS_CARRIERS = [56, 64, 114, 168, 208, 232, 30, 52, 100]

# Fixed values: (tx, rx) of each release's flattened links.
ANTENNA_LAYOUTS = {
    "ehunam": (1, 1), "exposing-csi": (1, 4), "figshare-csi-har": (2, 2),
    "glasgow-activity-localization": (1, 1), "glasgow-multiuser": (1, 1), "mm-fi": (1, 3),
    "nist-breathesmart": (2, 3), "ntu-fi": (1, 3), "operanet": (3, 3), "signfi": (1, 3),
    "ut-har": (1, 3), "wallhack18k": (1, 1), "wifi-80mhz": (1, 4),
    "wifi-presence-movement": (1, 3), "wimans": (3, 3), "wipe-fall": (1, 1),
    "wireless-har-wifi-uwb": (1, 3), "xrf-v2": (3, 3), "xrf55": (1, 9),
}

# Activity names.
ARIL_GESTURES = ["hand_up", "hand_down", "hand_left", "hand_right", "hand_circle", "hand_cross"]
CSIDA_GESTURES = ["pull left", "pull right", "lift up", "press down", "circle", "zigzag"]
UT_HAR_CLASSES = ["lie_down", "fall", "walk", "pickup", "run", "sit_down", "stand_up"]
WALLHACK_CLASSES = {"0": "no_presence", "1": "walking", "2": "arm_waving"}
WIFI_TAD_CLASSES = {1: "run", 2: "walk", 3: "jump", 4: "wave", 5: "bend", 6: "stand", 7: "sit"}
WIAR_ACTIVITIES = {
    1: "horizontal arm wave", 2: "high arm wave", 3: "two hands wave", 4: "high throw",
    5: "draw x", 6: "draw tick", 7: "toss paper", 8: "forward kick", 9: "side kick", 10: "bend",
    11: "hand clap", 12: "walk", 13: "phone call", 14: "drink water", 15: "sit down",
    16: "squat"}
MM_FI_ACTIVITIES = {
    "A01": "stretching and relaxing", "A02": "chest expansion (horizontal)",
    "A03": "chest expansion (vertical)", "A04": "twist left", "A05": "twist right",
    "A06": "mark time", "A07": "limb extension left", "A08": "limb extension right",
    "A09": "lunge left-front", "A10": "lunge right-front", "A11": "limb extension both",
    "A12": "squat", "A13": "raising hand left", "A14": "raising hand right",
    "A15": "lunge left side", "A16": "lunge right side", "A17": "waving hand left",
    "A18": "waving hand right", "A19": "picking up things", "A20": "throwing left",
    "A21": "throwing right", "A22": "kicking left", "A23": "kicking right",
    "A24": "body extension left", "A25": "body extension right", "A26": "jumping up",
    "A27": "bowing"}
EHUNAM_ACTIVITIES = {
    "J": "jumping", "W": "walking", "S": "standing", "T": "sitting",
    "G": "sit down / get up", "F": "falling"}
EXPOSING_CSI_ACTIVITIES = {
    "A": "walk", "B": "run", "C": "jump", "D": "sitting", "E": "empty_room", "F": "standing",
    "G": "wave_hands", "H": "clapping", "I": "lay_down", "J": "wiping", "K": "squat",
    "L": "stretching"}
WIFI_80MHZ_ACTIVITIES = {
    "W": "walking", "R": "running", "J": "jumping", "L": "sitting still", "S": "standing",
    "C": "sit down / stand up", "G": "arm exercises", "E": "empty room"}
WIRELESS_HAR_LABELS = {
    "kneel": "kneel", "liedown": "lie down", "pickup": "pick up", "sit": "sit",
    "sitrotate": "sit and rotate", "stand": "stand", "standrotate": "stand and rotate",
    "walk": "walk"}
GLASGOW_ACTIVITIES = {
    "emptyroom": "empty room", "leaning": "leaning", "noactivity": "no activity",
    "sitting": "sitting", "standing": "standing", "walkingrxtx": "walking Rx to Tx",
    "walkingtxrx": "walking Tx to Rx"}
XRF_V2_SCENES = {1: "dining room", 2: "study room", 3: "bedroom"}
XRF_V2_ACTIONS = {
    0: "stretching", 1: "pouring water", 2: "writing", 3: "cutting fruit", 4: "eating fruit",
    5: "taking medicine", 6: "drinking water", 7: "sitting down",
    8: "turning on/off eye protection lamp", 9: "opening/closing curtains",
    10: "opening/closing windows", 11: "typing", 12: "opening envelope",
    13: "throwing garbage", 14: "picking fruit", 15: "picking up items",
    16: "answering phone", 17: "using mouse", 18: "wiping table",
    19: "writing on blackboard", 20: "washing hands", 21: "using phone", 22: "reading",
    23: "watering plants", 24: "walking to bed", 25: "walking to chair",
    26: "walking to cabinet", 27: "walking to window", 28: "walking to blackboard",
    29: "getting out of bed", 30: "standing up", 31: "lying down", 32: "standing still",
    33: "lying still"}
XRF55_ACTIONS = {
    1: "carrying weight", 2: "mopping the floor", 3: "using a phone", 4: "throwing something",
    5: "picking something", 6: "putting something on the table", 7: "cutting something",
    8: "wearing a hat", 9: "putting on clothing", 10: "blowing dry hair", 11: "combing hair",
    12: "brushing teeth", 13: "drinking", 14: "eating", 15: "smoking", 16: "shaking hands",
    17: "hugging", 18: "handing something to someone", 19: "kicking someone",
    20: "hitting someone with something", 21: "choking someone's neck", 22: "pushing someone",
    23: "body weight squats", 24: "Tai Chi", 25: "boxing", 26: "weightlifting",
    27: "hula hooping", 28: "jumping rope", 29: "jumping jack", 30: "high leg lifting",
    31: "waving", 32: "clapping hands", 33: "falling on the floor", 34: "jumping",
    35: "running", 36: "sitting down", 37: "standing up", 38: "turning", 39: "walking",
    40: "stretching", 41: "patting on the shoulder", 42: "playing Er-Hu",
    43: "playing Ukulele", 44: "playing drum", 45: "foot stamping", 46: "shaking head",
    47: "nodding", 48: "drawing a circle", 49: "drawing a cross", 50: "pushing",
    51: "pulling", 52: "swiping left", 53: "swiping right", 54: "swiping up",
    55: "swiping down"}

# Display renames of raw labels, per data set.
DISPLAY_LABELS = {
    "operanet": {"background": "background", "noactivity": "no activity",
                 "liedown": "lie down", "standfromlie": "stand from floor",
                 "bodyrotate": "body rotate"},
    "wifi-80mhz": WIFI_80MHZ_ACTIVITIES,
    "wireless-har-wifi-uwb": {"liedown": "lie down", "pickup": "pick up",
                              "sitrotate": "sit and rotate", "standrotate": "stand and rotate"},
}

# The order in which a data set's labels are shown.
LABEL_ORDERS = {
    "wifi-presence-movement": ["Gone", "Approach", "Enter", "Mobile", "Stationary", "Exit",
                               "Departure"],
    "wifi-tad": ["run", "walk", "jump", "wave", "bend", "stand", "sit"],
}

# Tasks of the multi-task benchmark and the profile each one uses.
BENCH_TASK_PROFILES = {
    "BreathingDetection": "vital-sign", "FallDetection": "general-sensing",
    "Localization": "general-sensing", "MotionSourceRecognition": "general-sensing",
    "HumanActivityRecognition": "general-sensing", "HumanIdentification": "general-sensing",
    "ProximityRecognition": "general-sensing", "Multitask": "general-sensing"}
