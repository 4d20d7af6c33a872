"""Fixed vocabulary of the restoration ontology.

FIXED VALUES: every table in this module states, as plain text and in the
order the ontology declares them, facts that must equal the ontology the
models were prompted with (class names, parents, labels, property kinds,
domains, ranges, someValuesFrom restrictions).  They are data, not logic;
``sources.ontology.read_ontology`` derives the same tables from any Turtle
ontology file, and these rows are the default when no file is given.
"""

from __future__ import annotations

# FIXED VALUES: namespaces of the generated graphs.
ONTO_NS = "http://www.semanticweb.org/fethi/ontologies/2024/1/TetraOnto.owl#"
PREFIXES = {
    "": ONTO_NS,
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
}

# FIXED VALUES: the three prefix lines written before every zero-shot answer.
PREFIX_HEADER = (
    "@prefix : <http://www.semanticweb.org/fethi/ontologies/2024/1/TetraOnto.owl#> .\n"
    "@prefix skos: <http://www.w3.org/2004/02/skos/core#> .\n"
    "@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .\n"
)

# FIXED VALUES: models of the prompting sweep, in sweep order.
MODELS = ["qwen2.5:14b", "qwen2:7b", "llama3.2:latest", "llama3.1:8b", "llama3:latest", "mistral:latest"]

# FIXED VALUES: classes.  name | parents | English prefLabel | altLabel | altLabel language
CLASSES_TEXT = """
BypassSystem | fishway | Bypass System |  | 
Lake | waterBody | Lake | lac | fr
TrapSystem | fishway | Trap System |  | 
affluent | waterBody | affluent | affluent | fr
anadromous | amphibioticMigrant,migratorySpecie | anadromous | anadrome | fr
arm | waterBody | arm | bras | fr
artificialObstacle | barrier | artificial obstacle |  | 
baffleBrush | eelLadder | baffle brush | tapis brosse | fr
baffleFishway | basinPasses | baffle fishway | passe à chicanes | fr
biologicalMonitoring | restorationMonitoring | biological monitoring | suivi biologique | fr
catadromous | amphibioticMigrant,migratorySpecie | catadromous | catadrome | fr
channelCreation | restorationMeasure | channel creation | création d’un chenal | fr
counterDrainageChannel | waterBody | counter drainage channel | contre-canal de drainage | fr
country |  | country | pays | fr
de-silting | restorationMeasure | de-silting | désenvasement | fr
distributionBasin | fishway | distribution basin | bassin de répartition | fr
ecologicalMonitoring | restorationMonitoring | ecological monitoring | suivi écologique | fr
fishLift | eelLadder | fish lift | ascenseur à poissons | fr
fishLock | fishway | fish lock | écluse à poissons | fr
floodRetention | restorationMeasure | flood retention | rétention de crues | fr
flowRestoration | restoration | flow restoration | restauration de cours d'eau | fr
forestRestoration | restorationMeasure | forest restoration | restauration de forêts | fr
gate | structure | gate | vanne | fr
gravelInsertion | sedimentTransport | gravel insertion | engravement | fr
groyneModification | sedimentTransport | groyne modification | modification de l'épi | fr
habitatRestoration | restoration | habitat restoration | restauration des habitats | fr
holobioticMigrant | migratorySpecie | holobiotic migrant | migrateur amphibiotique | fr
hydromorphologicalMonitoring | restorationMonitoring | hydromorphological monitoring | suivi hydromorphologique | fr
inclinedWeirWithRedanUpstream | inclinedWeir | inclined weir with redan upstream | seuil incliné présentant un redan en amont | fr
lateralContinuityRestoration | restoration | lateral continuity restoration | restauration de continuité latérale | fr
lavoirWeir | weir | lavoir weir | seuil de lavoir | fr
longitudinalContinuityRestoration | restoration | longitudinal continuity restoration | restauration de la continuité longitudinale | fr
low-slopeRockfillWeir | weir | low-slope rockfill weir | seuil en enrochements à faible pente | fr
millWeir | weir | mill weir | seuil de moulin | fr
naturalObstacle | barrier | natural obstacle |  | 
nozzle | structure | nozzle | buse | fr
observationRoom | technicalElement | Observation room | Local d'observation | fr
otherActor |  | other actor | autre acteur | fr
pond | waterBody | pond | étang | fr
pondDyke | structure | pond dyke | digue d’étang | fr
poolCreation | restorationMeasure | pool creation | création de mares | fr
poolRestoration | restorationMeasure | pool restoration | restauration de mares | fr
pre-barrage | fishway | pre-barrage | pre-dam | en
profileDiversification | restorationMeasure | profile diversification | diversification des profils | fr
reconnection | restorationMeasure | reconnection | reconnexion | fr
redynamization | restorationMeasure | redynamization | redynamisation | fr
regularFlooding | restorationMeasure | regular flooding | inondations régulières | fr
restoringSpawningGrounds | restorationMeasure | restoring spawning grounds | restauration de frayères | fr
river | waterBody | river | rivière | fr
riverbankExcavation | sedimentTransport | riverbank excavation | déroctage de berge | fr
riverbankRestoration | restorationMeasure | riverbank restoration | restauration de berges | fr
roadStructure | structure | road structure | ouvrage routier | fr
routeModification | restorationMeasure | route modification | modification du tracé | fr
scientificMonitoring | restorationMonitoring | scientific monitoring | suivi scientifique | fr
sedimentRecharging | sedimentTransport | sediment recharging | recharge sédimentaire | fr
speedBumpsPass | fishway | speed bumps pass | passe à ralentisseurs | fr
steep-slopeRockfillWeir | weir | steep-slope rockfill weir | seuil en enrochement à forte pente | fr
studSubstrate | eelLadder | stud substrate | substrat rugueux | fr
submergedOrifice | technicalElement | submerged orifice | orifice immergé | fr
trapPass | eelLadder | trap pass | passe piège | fr
upstreamMigrationObstacle | barrier | upstream migration obstacle | obstacle à la migration en amont | fr
verticalSlot | technicalElement | vertical slot | fente verticale | fr
verticalSlotPassage | basinPasses | vertical slot passage | passage à fente verticale | fr
verticalWeir | weir | vertical weir | seuil vertical | fr
viewingWindow | technicalElement | viewing Window | vitre d’observation | fr
weirWaterBody | technicalElement | weir water body | seuil | fr
weirWithASuccessionOfRedans | weir | weir with a succession of redans | seuil présentant une succession de redans | fr
wetland | waterBody | wetland | zone humide | fr
dam | structure | dam | barrage | en
inclinedWeir | weir | inclined weir | seuil incliné | fr
mainContractor |  | main contractor | maître d'œuvre | fr
otherElement | technicalElement | other element |  | 
projectOwner |  | project owner | maîre d'ouvrage | fr
amphibioticMigrant | migratorySpecie | amphibiotic migrant | diadromous | en
basinPasses | fishway | basin passes | passes à bassins | fr
barrier |  | barrier | obstacle | en
notch | technicalElement | notch | échancrure | fr
pool | technicalElement | pool | basin | fr
eelLadder | fishway | eel ladder | passe à anguilles | fr
migratorySpecie |  | migratory specie | espèce migrateur | fr
sedimentTransport | restorationOperation | sediment transport | transport sédimentaire | fr
artificialRiver | fishway | artificial river | rivière artificielle | fr
restoration |  | restoration | restauration | fr
weir | technicalElement | weir | seuil | fr
fishway | restorationOperation | fishway | passe à poissons | fr
technicalElement |  | technical element |  | 
waterBody |  | water body | cours d'eau | fr
restorationOperation |  | restoration operation |  | 
geographicZone |  | geographic zone |  | 
restorationMonitoring |  | restoration monitoring | suivi de la restauration | fr
structure |  | structure | ouvrage | fr
restorationMeasure |  | restoration measure | mesure de restauration | fr
"""

# FIXED VALUES: properties.  name | object/data | domains | ranges
PROPERTIES_TEXT = """
containsNotch | object | restorationOperation | notch
containsOtherElements | object | restorationOperation | otherElement
containsPool | object | restorationOperation | pool
endsAt | data | restorationMeasure | xsd:dateTime
hasAverageSlope | data | artificialRiver | xsd:string
hasBiologicalMonitoring | data | restorationMeasure | xsd:boolean
hasCategory | object | restorationMeasure | restoration
hasDescription | data | restorationMeasure | xsd:string
hasFonctionality | data | restorationMeasure | xsd:boolean
hasFunction | data | restorationOperation | xsd:string
hasHeight | data | dam,structure | owl:real
hasHeightBetweenBasins | data |  | 
hasHydromorphologicalMonitoring | data | restorationMeasure | xsd:boolean
hasLength | data | artificialRiver | xsd:decimal
hasMainContractor | object | restorationMeasure | mainContractor
hasMaxLowWaterFlow | data | artificialRiver | xsd:float
hasMinLowWaterFlow | data | artificialRiver | xsd:float
hasMonitoringCost | data | restorationMonitoring | xsd:decimal
hasMonitoringDescription | data | restorationMonitoring | xsd:string
hasMonitoringEndDate | data | restorationMonitoring | xsd:dateTime
hasMonitoringStartDate | data | restorationMonitoring | xsd:dateTime
hasNotchHigh | data | notch | xsd:integer
hasNotchWidth | data | notch | xsd:integer
hasNotches | data |  | 
hasNumberOfBasins | data | restorationOperation | xsd:integer
hasNumberOfEntries | data | restorationMeasure | xsd:integer
hasNumberOfInstallations | data | restorationOperation | xsd:integer
hasNumberOfPools | data | restorationOperation | xsd:integer
hasPoolLength | data | pool | xsd:integer
hasPoolWidth | data | pool | xsd:integer
hasPurpose | data | restorationMeasure | xsd:string
hasWidth | data | artificialRiver | xsd:decimal
isImpassable | data | structure | xsd:boolean
isLocatedIn | data |  | 
isManagedBy | object | restorationMeasure | projectOwner
startsAt | data | restorationMeasure | xsd:dateTime
includes | object | restorationMeasure | restorationOperation
isLocatedOn | object | restorationMeasure,structure | geographicZone,waterBody
associatedMeas | object | restorationOperation | restorationMeasure
associatedTo | object | restorationMeasure | structure
isSubjectTo | object | restorationMeasure | restorationMonitoring
realizedIn | object | restorationMeasure | geographicZone
hasCost | data | restorationMeasure | xsd:decimal
"""

# FIXED VALUES: someValuesFrom restrictions on classes.  class | property | filler
RESTRICTIONS_TEXT = """
baffleBrush | hasCost | xsd:decimal
baffleBrush | associatedMeas | restorationMeasure
baffleBrush | associatedTo | structure
baffleBrush | isSubjectTo | restorationMonitoring
baffleBrush | realizedIn | geographicZone
baffleFishway | associatedMeas | restorationMeasure
baffleFishway | associatedTo | structure
baffleFishway | isSubjectTo | restorationMonitoring
baffleFishway | realizedIn | geographicZone
baffleFishway | hasCost | xsd:decimal
fishLift | associatedMeas | restorationMeasure
fishLift | associatedTo | structure
fishLift | isSubjectTo | restorationMonitoring
fishLift | realizedIn | geographicZone
fishLift | hasCost | xsd:decimal
fishLock | associatedMeas | restorationMeasure
fishLock | associatedTo | structure
fishLock | isSubjectTo | restorationMonitoring
fishLock | realizedIn | geographicZone
fishLock | hasCost | xsd:decimal
gravelInsertion | associatedTo | structure
gravelInsertion | isSubjectTo | restorationMonitoring
gravelInsertion | realizedIn | geographicZone
gravelInsertion | hasCost | xsd:decimal
groyneModification | associatedTo | structure
groyneModification | isSubjectTo | restorationMonitoring
groyneModification | realizedIn | geographicZone
groyneModification | hasCost | xsd:decimal
pre-barrage | associatedMeas | restorationMeasure
pre-barrage | associatedTo | structure
pre-barrage | isSubjectTo | restorationMonitoring
pre-barrage | realizedIn | geographicZone
pre-barrage | hasCost | xsd:decimal
riverbankExcavation | associatedTo | structure
riverbankExcavation | isSubjectTo | restorationMonitoring
riverbankExcavation | realizedIn | geographicZone
riverbankExcavation | hasCost | xsd:decimal
sedimentRecharging | associatedTo | structure
sedimentRecharging | isSubjectTo | restorationMonitoring
sedimentRecharging | realizedIn | geographicZone
sedimentRecharging | hasCost | xsd:decimal
speedBumpsPass | associatedMeas | restorationMeasure
speedBumpsPass | associatedTo | structure
speedBumpsPass | isSubjectTo | restorationMonitoring
speedBumpsPass | realizedIn | geographicZone
speedBumpsPass | hasCost | xsd:decimal
studSubstrate | associatedMeas | restorationMeasure
studSubstrate | associatedTo | structure
studSubstrate | isSubjectTo | restorationMonitoring
studSubstrate | realizedIn | geographicZone
studSubstrate | hasCost | xsd:decimal
trapPass | associatedMeas | restorationMeasure
trapPass | associatedTo | structure
trapPass | isSubjectTo | restorationMonitoring
trapPass | realizedIn | geographicZone
trapPass | hasCost | xsd:decimal
verticalSlotPassage | associatedMeas | restorationMeasure
verticalSlotPassage | associatedTo | structure
verticalSlotPassage | isSubjectTo | restorationMonitoring
verticalSlotPassage | realizedIn | geographicZone
verticalSlotPassage | hasCost | xsd:decimal
basinPasses | associatedMeas | restorationMeasure
basinPasses | associatedTo | structure
basinPasses | isSubjectTo | restorationMonitoring
basinPasses | realizedIn | geographicZone
basinPasses | hasCost | xsd:decimal
eelLadder | associatedMeas | restorationMeasure
eelLadder | associatedTo | structure
eelLadder | isSubjectTo | restorationMonitoring
eelLadder | realizedIn | geographicZone
eelLadder | hasCost | xsd:decimal
sedimentTransport | associatedTo | structure
sedimentTransport | isSubjectTo | restorationMonitoring
sedimentTransport | realizedIn | geographicZone
sedimentTransport | hasCost | xsd:decimal
artificialRiver | associatedMeas | restorationMeasure
artificialRiver | associatedTo | structure
artificialRiver | isSubjectTo | restorationMonitoring
artificialRiver | realizedIn | geographicZone
artificialRiver | hasCost | xsd:decimal
fishway | associatedMeas | restorationMeasure
fishway | associatedTo | structure
fishway | isSubjectTo | restorationMonitoring
fishway | realizedIn | geographicZone
fishway | hasCost | xsd:decimal
restorationOperation | hasCost | xsd:decimal
structure | isLocatedOn | waterBody
restorationMeasure | includes | restorationOperation
restorationMeasure | isLocatedOn | geographicZone
"""

# FIXED VALUES: restrictions written inside property domains.  property | property | filler
DOMAIN_RESTRICTIONS_TEXT = """
endsAt | hasCost | xsd:decimal
hasDescription | hasCost | xsd:decimal
hasPurpose | hasCost | xsd:decimal
hasCost | hasCost | xsd:decimal
"""

# FIXED VALUES: names used in the prompts and worked example that differ from
# the ontology (vocabulary drift), mapped to the ontology term they mean.
ALIASES_TEXT = """
relizedIn | realizedIn
containsTechnicalElement | includes
concerns | hasCategory
endssAt | endsAt
hasMixLowWaterFlow | hasMinLowWaterFlow
hasNotchHight | hasNotchHigh
numberOfPools | hasNumberOfPools
numberOfBasins | hasNumberOfBasins
averageSlope | hasAverageSlope
hasHydromorphologicaMonitoring | hasHydromorphologicalMonitoring
successivesBasinsPass | basinPasses
preBarrage | pre-barrage
lowSlopeRockfillWeir | low-slopeRockfillWeir
associateTo | associatedTo
"""


def _rows(text: str) -> list[tuple[str, ...]]:
    return [tuple(c.strip() for c in line.split("|")) for line in text.strip().splitlines() if line.strip()]


# FIXED VALUES: further alternative labels.  class | label | language
MORE_LABELS_TEXT = """
pre-barrage | prébarrage | fr
dam | barrage | fr
barrier | barrière | fr
barrier | obstacle | fr
"""


def labels() -> list[tuple[str, str, str, str]]:
    """(class, label, language, pref|alt), every label of the ontology."""
    cls = classes()
    return [(n, p, "en", "pref") for n, _, p, _, _ in cls if p] + [(n, a, lang, "alt") for n, _, _, a, lang in cls if a] \
        + [(n, a, lang, "alt") for n, a, lang in _rows(MORE_LABELS_TEXT)]


def classes() -> list[tuple[str, list[str], str, str, str]]:
    return [(n, [p for p in ps.split(",") if p], pref, alt, lang) for n, ps, pref, alt, lang in _rows(CLASSES_TEXT)]


def properties() -> list[tuple[str, str, list[str], list[str]]]:
    return [(n, k, [d for d in ds.split(",") if d], [r for r in rs.split(",") if r])
            for n, k, ds, rs in _rows(PROPERTIES_TEXT)]


def restrictions() -> list[tuple[str, str, str]]:
    return _rows(RESTRICTIONS_TEXT)


def domain_restrictions() -> list[tuple[str, str, str]]:
    return _rows(DOMAIN_RESTRICTIONS_TEXT)


def aliases() -> list[tuple[str, str]]:
    return _rows(ALIASES_TEXT)
