"""Attribute-list documents of the recruiting system.

Fixed values: tables, attribute names and kinds, in output order.
"""

from ..specs import AttributeSpec, fields


def _attributes(name: str, text: str) -> AttributeSpec:
    return AttributeSpec(name, ("icims_raw", name), fields(text))


ICIMS = (
    _attributes(
        "company",
        """
            name:str externalid:str field61991:label field30416:str field30415:str
            field62851:str field27655:label field30414:str field30410:str
            field30412:str field30413:str synopsis:str i9classification:label
            field62979:str field62978:str field68748:str field30411:str
            field63187:str field58047:str quicksearch:str createdby:id
            createddate:ts updatedby:id field30426:id fulltext:str folder:label
            updateddate:ts field30389:str addresses:str field27846:label
            field68934:str field61990:label field27823:str field61992:label
            field63938:str field30425:id field63937:str field27845:label
            field68749:str field30417:str
        """,
    ),
    _attributes(
        "connectevent",
        """
            startdate:ts host:label externalmessages:str additionaldetails:str
            updateddate:ts updatedby:id folder:label category:label enddate:ts
            quicksearch:str title:str createddate:ts createdby:id cost:label
        """,
    ),
    _attributes(
        "connecteventworkflow",
        """
            baseprofile:id updatedby:id updateddate:ts associatedprofile:id
            status:label createddate:ts attendance:label createdby:id
        """,
    ),
    _attributes(
        "connecteventworkflowsource",
        """
            talentpool:id eventattendee:id updatedby:id createddate:ts
            updateddate:ts createdby:id
        """,
    ),
    _attributes(
        "room",
        """
            email:str folder:label createdby:id title:str updateddate:ts
            quicksearch:str createddate:ts updatedby:id
        """,
    ),
    _attributes(
        "sourceworkflow",
        """
            sourcename:label baseprofile:id sourceperson:id status:label
            source:label field61046:id updatedby:id createdby:id createddate:ts
            updateddate:ts sourceorigin:label vendorname:str associatedprofile:id
        """,
    ),
    _attributes(
        "submittal",
        """
            sourceperson:id baseprofile:id field57146:str field31565:label
            field31541:str field28057:var field31605:var field31536:var
            field29359:var field29324:label field31532:id field28014:label
            field31538:str field72067:label sourceexternalid:str field59292:label
            sourcename:str createdby:id quicksearch:str field57213:label
            field57201:str assessmentresults:var field31529:label
            field31141:label field29330:str field58091:var field31057:var
            field71367:num field56940:label field57396:label field56942:label
            field57608:var field58722:var field57204:label field57197:label
            field30649:var field28067:str field61655:label field30330:var
            acceptdeclinedate:ts field71087:label field57304:num
            associatedprofile:id field57145:label field57147:str field57286:str
            field31717:label field31567:label field31117:str
            proposedstartdate:ts field62705:str field69194:label
            counteroffer:var field31850:label field59293:label field31530:str
            field62125:str status:label source:str field28017:label
            field31528:label field31601:str field69127:label field62706:label
            field57200:ts field69188:var field58265:label field69189:label
            createddate:ts field57209:label field31531:label field31762:label
            field30316:label field29363:var field29365:str field58187:num
            field56513:num field31159:label bonus:label field31533:str
            field56871:num sourcechannel:str field57207:label field57194:ts
            field31527:id field28064:label field31607:str field69937:label
            field31138:str field29261:label field31853:label field59706:ts
            sourceorigin:label portal:str sourcedevice:str jibesessionid:str
            field57148:str field30323:label field29361:id field72013:num
            field29318:label field31707:label field31606:label field56868:num
            field28025:id offerexpiration:ts offeramount:var field69190:label
            field31539:str field63660:str field57211:label field31534:label
            field31604:var field31120:label field61347:str field31562:label
            field31711:ts field31526:label field71676:label
            relocationamount:label field31190:num updatedby:id field57198:str
            field61071:str field58039:id field28063:label field58092:var
            field31603:str field28065:label field31130:label field31578:var
            field62704:str field56941:str field29265:label field57203:str
            field31196:label field31158:label field58192:label field29369:label
            field31566:ts field69186:str field31580:str field31602:label
            field31540:label field57212:label field57196:str field57205:ts
            updateddate:ts field57509:var field69163:label field31134:label
            field62007:str field31599:id field31155:label field31187:str
            field57908:label field57195:ts field57210:label field63765:label
            field28066:ts field32036:id field28062:str field57536:var
            field57214:ts field69187:str field29303:label field29304:label
            field56945:label field57609:ts field57199:label field57430:id
            field31600:num field31490:label field31537:str field56943:label
            field56944:label field31183:num field57208:str field63728:label
            jibeuserid:str field31563:id field31535:label field28015:str
            field63931:label field31851:label field31704:ts field61436:str
            field57542:ts field57202:label field31564:str field31761:label
            field31483:label field29331:str sourceemail:str field60871:str
            field29360:id field31849:label
        """,
    ),
    _attributes(
        "talentpool",
        """
            overview:str externalid:str updatedby:id createddate:ts folder:label
            updateddate:ts title:str createdby:id quicksearch:str owner:id
        """,
    ),
)
