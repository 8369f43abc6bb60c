"""Curated subject terms: what a text about an area speaks of, one line of terms for each area of the taxonomy."""

TERMS = {
    "algal blooms": "algal scums; bloom duration; bloom toxins; chlorophyll peaks; cyanobacteria; diatom assemblages; harmful algal blooms; microcystin levels; nutrient loading; phycocyanin sensors; phytoplankton counts; saxitoxin",
    "aquifer science": "aquifer recharge; aquitard leakage; confined aquifers; groundwater pumping; hydraulic head; land subsidence; managed recharge basins; monitoring wells; seawater intrusion; specific yield; water table decline; well drawdown",
    "biological invasions": "alien species; ballast water; early detection surveys; eradication trials; herbicide plots; introduced predators; invader density; invasion fronts; invasive mussels; non-native clams; water hyacinth; waterweed control",
    "canal and pipe systems": "aqueduct capacity; canal lining; conveyance losses; intake screens; pipe corrosion; pipeline leakage; pumping plants; siphon crossings; surge tanks; tunnel boring; turnout gates; valve control",
    "carbon accounting": "blue carbon; carbon credits; carbon offsets; carbon sequestration; decarbonised pumping; eddy covariance towers; emission factors; emission inventories; greenhouse gas budgets; methane emissions; net-zero targets; nitrous oxide",
    "community water access": "affordability gaps; bottled water reliance; community surveys; disadvantaged households; domestic well failures; equity indicators; household shut-offs; lifeline rates; rural hauling; small water systems; tribal consultation; underserved communities",
    "dam safety": "concrete ageing; dam breach; dam inspection; embankment stability; freeboard limits; internal erosion; levee failure; levee seepage; outlet gates; overtopping risk; piezometer readings; spillway erosion",
    "desalination and reuse": "advanced oxidation; brackish feedwater; brine disposal; concentrate management; desalting plants; effluent polishing; membrane fouling; potable reuse; recycled wastewater; reverse osmosis; tertiary treatment; ultrafiltration",
    "drought studies": "aridity trends; drought indices; drought recovery; dry spells; evaporative demand; flash drought; hot dry summers; low-flow years; multi-year drought; precipitation shortfall; rainfall deficit; tree-ring reconstructions",
    "hydropower operations": "generator outages; grid demand; head loss; hydropower revenue; megawatt output; peaking generation; penstock design; power scheduling; pumped storage; ramping rates; run-of-river plants; turbine efficiency",
    "molecular monitoring": "allele frequencies; amplicon libraries; environmental dna; filter extraction; genetic markers; genotyping panels; haplotype diversity; metabarcoding; population genomics; primer design; qpcr assays; sequence reads",
    "outreach and training": "citizen science; classroom modules; curriculum units; field trips; learning outcomes; museum exhibits; school gardens; science fairs; student projects; summer internships; teacher workshops; volunteer samplers",
    "remote sensing": "airborne sensors; drone flights; image mosaics; lidar surveys; multispectral bands; orbital repeat passes; pixel classification; point clouds; radar interferometry; satellite imagery; thermal images; vegetation index maps",
    "river hydraulics": "backwater effects; bankfull flow; channel bathymetry; channel roughness; discharge rating curves; flood stage; floodplain inundation; flow routing; hydrodynamic models; peak discharge; streamflow gauges; tidal velocity",
    "salmonid biology": "acoustic tags; adult returns; escapement counts; fish passage; fry emergence; hatchery releases; juvenile salmon; otolith rings; smolt survival; spawning redds; steelhead migration; trout growth",
    "sediment transport": "bed shear stress; bedload flux; delta accretion; grain size; gravel augmentation; reservoir sedimentation; sand bars; scour depth; sediment budget; silt deposition; suspended sediment; turbidity pulses",
    "seismic hazards": "aftershock sequences; earthquake shaking; fault creep; fault slip; ground motion; liquefaction; magnitude estimates; paleoseismic trenches; rupture length; seismic velocity; seismometer arrays; shear wave profiles",
    "snow and ice science": "avalanche cycles; firn layers; frozen ground; glacier retreat; lake ice cover; melt onset; snow albedo; snow pillows; snow water equivalent; snowline elevation; snowpack; winter accumulation",
    "soils and irrigation": "almond orchards; clay loam; crop water use; drip emitters; evapotranspiration plots; field capacity; infiltration rates; irrigation scheduling; root zone salinity; soil carbon; soil moisture; tile drains",
    "statistical learning": "cross-validation; ensemble learners; feature importance; gradient boosting; hyperparameters; model overfitting; neural networks; prediction skill; random forests; recurrent models; training data; transfer learning",
    "storm dynamics": "atmospheric moisture plumes; cloud microphysics; convective cells; cyclone landfall; frontal passages; lightning counts; precipitation forecasts; pressure troughs; radar reflectivity; rain bands; storm tracks; wind shear",
    "water law and governance": "agency mandates; court rulings; curtailment orders; governance networks; interstate compacts; permit conditions; public hearings; regulatory compliance; riparian claims; stakeholder agreements; statutory reform; water rights",
    "water markets": "benefit-cost ratios; cost recovery; economic losses; fallowing payments; marginal value; market liquidity; price elasticity; rate structures; tariff design; transfer markets; water trading; willingness to pay",
    "waterbird ecology": "bird banding; brood surveys; crane roosts; duck nesting; flyway habitat; grebe diets; heron colonies; nest predation; rail calls; shorebird counts; tern chicks; waterfowl wintering",
    "wetland ecology": "emergent plants; marsh accretion; mudflat fauna; peat formation; pickleweed cover; seasonal wetlands; sedge meadows; tidal marsh; tule stands; vernal pools; wetland restoration; wetland vegetation",
    "wildfire effects": "ash deposits; burn severity; charred slopes; debris flows; fire perimeters; fire return intervals; fuel loads; hydrophobic layers; post-fire runoff; prescribed burning; scorched canopy; smoke plumes",
}
